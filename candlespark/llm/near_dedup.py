"""Near-duplicates by b-bit MinHash.

A text's set holds its distinct shingles of ``size`` words (64-bit hashes). ``HASHES`` minima are kept: in full
for the bands, their lowest ``BITS`` bits packed into longs. Texts of equal sets are one class. Classes that share a
band are candidates; bit counts over the packed signatures estimate their similarity, corrected for chance
agreement, and estimates clearly below the threshold are dropped; the rest is confirmed on full sets.

A band's members are not paired with each other: first each is compared with the band's smallest class, then in
``ROUNDS`` rounds with one drawn for each band. Bands whose members are linked by then need nothing more; in the
others, members of different components are compared, all of them, block by block inside tasks that return only
pairs whose estimate passes and whose parity bits leave a link possible. So a large group of copies costs a few pairs per member, and no link between different texts is lost but by
the bands themselves (chance 4.7e-8 at 0.8) or by the estimate (4.3e-9): 5.2e-8 at most together.

Edge cases: a text with fewer words than ``size`` has its whole sequence as one shingle; a null or blank text has an
empty set, is linked with nothing and is its own component. Repeated rows have equal sets, hence one component.
A null ``doc_id`` comes after all others. Extra columns pass through ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlespark.llm.common import stored, text_key
from candlespark.session import materialize

HASHES, ROWS, BITS = 128, 4, 2
BANDS = HASHES // ROWS
#: Estimates below the threshold by more than this are dropped. At similarity 0.8 equal minima are Bin(128, 0.85), and fewer
#: than the 83 that pass have a chance of 4.3e-9, below that of the bands.
MARGIN = 0.27
#: Remainders whose parities bound how much two sets can overlap.
PARITIES = 2048
#: Rows of a block, of which two are compared at a time.
BLOCK = 2048
#: Rounds that compare a band's members with one of them before all are compared.
ROUNDS = 1


def _hashing():
    """Functions used inside tasks; built there, so that workers need no import of this package."""
    import re

    import numpy as np

    word = re.compile(rb"[^\x20\x09-\x0D]+")
    upper, lower = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
    fold = bytes.maketrans(upper, lower)
    known: dict[bytes, int] = {}

    def mix(x):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))

    def shingles(text: str | None, size: int):
        """Sorted distinct hashes of the shingles."""
        import xxhash

        words = word.findall((text or "").encode("utf-8", "surrogatepass").translate(fold))
        if not words:
            return np.empty(0, "uint64")
        if len(known) > 300_000:
            known.clear()
        get, code = known.get, xxhash.xxh3_64_intdigest
        ids = []
        for w in words:
            h = get(w)
            if h is None:
                h = code(w)
                if len(w) < 64:
                    known[w] = h
            ids.append(h)
        ids = np.array(ids, "uint64")
        size = min(size, len(ids))
        with np.errstate(over="ignore"):
            out = np.full(len(ids) - size + 1, size, "uint64")
            for k in range(size):
                out = mix(out * np.uint64(0x9E3779B97F4A7C15) + ids[k : len(ids) - size + 1 + k])
        return np.unique(out)

    return np, mix, shingles


SIGNED = "doc_id bigint, text_key bigint, class bigint, n_shingles bigint, bands array<bigint>, packed array<bigint>"


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """Per row its set's class, size, band values and packed signature."""

    def sign(batches: Iterator) -> Iterator:
        import pandas as pd

        np, mix, shingles = _hashing()
        random = np.random.default_rng(1)
        odd = random.integers(0, 2**63, HASHES, dtype="uint64") * np.uint64(2) + np.uint64(1)
        add = random.integers(0, 2**63, HASHES, dtype="uint64")
        band_number = np.arange(BANDS, dtype="uint64")
        places = np.arange(HASHES, dtype="uint64") % np.uint64(32) * np.uint64(BITS)
        for batch in batches:
            out = []
            for doc, key, text in zip(batch.doc_id, batch.text_key, batch.text):
                s = shingles(text, size)
                if not len(s):
                    out.append((doc, key, None, 0, [], []))
                    continue
                with np.errstate(over="ignore"):
                    high = np.full(HASHES, np.iinfo("uint64").max, "uint64")
                    for low in range(0, len(s), 2048):
                        part = s[low : low + 2048]
                        high = np.minimum(high, (part[:, None] * odd[None, :] + add[None, :]).min(axis=0))
                    # The multiply leaves low bits weak; the minima are mixed before bits are taken.
                    minima = mix(high)
                    value = band_number + np.uint64(1)
                    for k in range(ROWS):
                        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + minima[k::ROWS])
                    packed = ((minima & np.uint64(2**BITS - 1)) << places).reshape(-1, 32)
                    packed = np.bitwise_or.reduce(packed, axis=1)
                    whole = mix(np.uint64(len(s)) * np.uint64(0x9E3779B97F4A7C15) + mix(s).sum() ^ np.bitwise_xor.reduce(mix(s + np.uint64(1))))
                out.append((doc, key, int(np.int64(whole.astype("int64"))), len(s), value.view("int64"), packed.view("int64")))
            columns = ["doc_id", "text_key", "class", "n_shingles", "bands", "packed"]
            yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64", "class": "Int64"})

    return docs.select(F.col("doc_id").cast("bigint"), text_key(F.col("text")).alias("text_key"), "text").mapInPandas(sign, SIGNED)


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """``text_key, shingles`` of each row, and ``bits``: of each remainder, whether an odd number of shingles has it."""

    def build(batches: Iterator) -> Iterator:
        import pandas as pd

        np, _, shingles = _hashing()

        def parity(s):
            odd = np.bincount((s & np.uint64(PARITIES - 1)).astype("int64"), minlength=PARITIES) & 1
            return np.packbits(odd.astype("uint8")).view("int64")

        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.iloc[low : low + 256]
                found = [shingles(t, size) for t in part.text]
                yield pd.DataFrame({"text_key": part.text_key, "shingles": [s.view("int64") for s in found], "bits": [parity(s) for s in found]})

    return docs.select("text_key", "text").mapInPandas(build, "text_key bigint, shingles array<bigint>, bits array<bigint>")


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures: share of equal ``BITS``-bit minima, corrected for chance."""
    same = F.lit(HASHES)
    for i in range(HASHES * BITS // 64):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        differ = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
        same = same - F.bit_count(differ)
    return (same / HASHES - 0.5**BITS) / (1 - 0.5**BITS)


def components(edges: DataFrame, rows: int) -> DataFrame:
    """``node, root`` of every node of ``a, b`` edges; root: the component's smallest node.

    Large-star and small-star rounds: the number of rounds grows with the logarithm of a component's width, and no
    round needs the neighbours of a node together. ``rows``: about how many edges there are.
    """
    edges = edges.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).filter("low < high").distinct()
    current = stored(edges, "star", rows)
    # One row: edges that stay the same from one round to the next are told by their number and two sums of hashes.
    fingerprint = lambda df: df.agg(F.count("*"), F.bit_xor(F.xxhash64("low", "high")), F.bit_xor(F.xxhash64("high", F.lit(1), "low"))).first()
    mark = fingerprint(current)
    while True:
        both = current.unionByName(current.select(F.col("high").alias("low"), F.col("low").alias("high")))
        least = both.groupBy(F.col("low").alias("node")).agg(F.min("high").alias("near")).select("node", F.least("node", "near").alias("least"))
        large = both.filter("high > low").join(least, F.col("low") == F.col("node")).select(F.col("least").alias("low"), "high")
        # Small star: each node's smaller neighbours and itself move below the smallest of them.
        down = large.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))
        small = large.join(down, F.col("high") == F.col("node")).select("least", "low", "high")
        small = small.select("least", F.explode(F.array("low", "high")).alias("high")).filter("least < high").distinct()
        after = stored(small.select(F.col("least").alias("low"), "high"), "star", 2 * rows)
        seen, current = mark, after
        mark = fingerprint(current)
        if mark == seen:
            break
    return current.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("root"))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets overlap enough."""
    one = pairs.join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("left")), "a")
    two = one.join(sets.select(F.col("class").alias("b"), F.col("shingles").alias("right")), "b")
    common = F.size(F.array_intersect("left", "right"))
    counted = two.select("a", "b", common.alias("common"), (F.size("left") + F.size("right")).alias("both"))
    return counted.filter(100 * F.col("common") >= percent * (F.col("both") - F.col("common"))).select("a", "b")


def may_overlap(a: str, b: str, percent: int) -> Column:
    """False where the parity bits of two sets differ in more places than linked sets of these sizes can."""
    differ = sum((F.bit_count(F.get(f"{a}.bits", F.lit(i)).bitwiseXOR(F.get(f"{b}.bits", F.lit(i)))) for i in range(PARITIES // 64)), F.lit(0))
    return differ * (100 + percent) <= (F.col(f"{a}.n") + F.col(f"{b}.n")) * (100 - percent)


def apart_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of one band and different roots that pass both bounds.

    A band's members are dealt to blocks of about ``BLOCK`` rows, and two blocks at a time are compared; nothing but the
    pairs that pass leaves a task, and a large band is spread over as many tasks as it has pairs of blocks.
    """
    floor = percent / 100 - MARGIN

    def compare(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        names = ("band", "i", "j", "own", "class", "root", "n")

        def pairs(g, low, high):
            rows = {k: v[low:high] for k, v in g.items()}
            same = rows["i"][0] == rows["j"][0]
            left = np.arange(high - low) if same else np.flatnonzero(rows["own"] == rows["i"][0])
            right = left if same else np.flatnonzero(rows["own"] == rows["j"][0])
            for at in range(0, len(left), 64):
                x, y = left[at : at + 64], right[at:] if same else right
                nx, ny = rows["n"][x][:, None], rows["n"][y][None, :]
                near = (rows["root"][x][:, None] != rows["root"][y][None, :]) & (100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny))
                p, q = np.nonzero(near)
                p, q = x[p], y[q]
                keep = p < q if same else np.ones(len(p), bool)
                p, q = p[keep], q[keep]
                for start in range(0, len(p), 50_000):
                    a, b = p[start : start + 50_000], q[start : start + 50_000]
                    differ = rows["packed"][a] ^ rows["packed"][b]
                    differ = (differ | (differ >> np.uint64(1))) & np.uint64(0x5555555555555555)
                    share = 1 - np.bitwise_count(differ).sum(1, dtype="int64") / HASHES
                    keep = (share - 0.5**BITS) / (1 - 0.5**BITS) >= floor
                    a, b = a[keep], b[keep]
                    odd = np.bitwise_count(rows["bits"][a] ^ rows["bits"][b]).sum(1, dtype="int64")
                    keep = odd * (100 + percent) <= (rows["n"][a] + rows["n"][b]) * (100 - percent)
                    a, b = rows["class"][a[keep]], rows["class"][b[keep]]
                    if len(a):
                        yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

        def groups(g, complete):
            size = len(g["band"])
            new = (np.diff(g["band"]) != 0) | (np.diff(g["i"]) != 0) | (np.diff(g["j"]) != 0)
            edges = [0, *(np.flatnonzero(new) + 1).tolist(), size]
            return list(zip(edges[:-1], edges[1:])) if complete else list(zip(edges[:-2], edges[1:-1]))

        held = None
        for batch in batches:
            if not len(batch):
                continue
            g = {k: batch[k].to_numpy("int64") for k in names}
            g |= {k: np.stack(batch[k]).view("uint64") for k in ("packed", "bits")}
            held = g if held is None else {k: np.concatenate([held[k], g[k]]) for k in g}
            done = groups(held, False)
            for low, high in done:
                yield from pairs(held, low, high)
            if done:
                held = {k: v[done[-1][1] :] for k, v in held.items()}
        if held is not None:
            for low, high in groups(held, True):
                yield from pairs(held, low, high)

    cuts = members.groupBy("band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("cuts"))
    placed = members.join(cuts, "band").withColumn("own", F.pmod(F.xxhash64("class"), F.col("cuts")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    dealt = placed.select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "class", "root", "n", "packed", "bits")
    dealt = dealt.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    return dealt.mapInPandas(compare, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row ``doc_id, text_key, n_shingles, component_id``; words are shingled by ``size``, links need ``percent``."""
    signed = materialize(signatures(docs, size), "near-signatures")
    rows = signed.count()
    classes = signed.filter("class IS NOT NULL").groupBy("class").agg(
        F.min("text_key").alias("text_key"), F.any_value("n_shingles").alias("n"), F.any_value("packed").alias("packed"), F.any_value("bands").alias("bands")
    )
    classes = stored(classes, "near-classes", rows)
    banded = classes.select("class", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("members"), F.min("class").alias("first")).filter("members > 1")
    banded = stored(banded.join(shared, "band").select("band", "class", "first"), "near-bands", rows)
    floor = percent / 100 - MARGIN
    slim = classes.select("class", "n", "packed")

    def promising(a: str, b: str) -> Column:
        smaller, larger = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
        return (100 * smaller >= percent * larger) & (estimate(F.col(f"{a}.packed"), F.col(f"{b}.packed")) >= floor)

    stars = banded.filter("first < class").select(F.col("first").alias("a"), F.col("class").alias("b")).distinct()
    stars = (
        stars.join(slim.alias("x"), F.col("a") == F.col("x.class")).join(slim.alias("y"), F.col("b") == F.col("y.class"))
        .filter(promising("x", "y")).select("a", "b")
    )
    stars = stored(stars, "near-stars", rows)
    taking_part = stored(banded.select("class").distinct(), "near-taking-part", rows)
    keyed = docs.select(text_key(F.col("text")).alias("text_key"), "text")
    wanted = classes.join(taking_part, "class").select("class", "text_key")
    texts = keyed.join(wanted.select("text_key").distinct(), "text_key", "left_semi").dropDuplicates(["text_key"])
    sets = stored(shingle_sets(texts, size).join(wanted, "text_key").select("class", "shingles", "bits"), "near-sets", rows)
    parities, sets = sets.select("class", "bits"), sets.select("class", "shingles")
    links = stored(_confirm(stars, sets, percent), "near-links", rows)
    tested, roots = stars, components(links, rows)

    # Second step: members of one band that are still apart. A few rounds compare them with one member per band,
    # drawn anew for each band and round; then those of different components are compared, all of them.
    banded = banded.select("band", "class")
    for turn in range(ROUNDS + 1):
        members = banded.join(roots, F.col("class") == F.col("node"), "left").select("band", "class", F.coalesce("root", "class").alias("root"))
        apart = members.groupBy("band").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least < most").select("band")
        members = stored(members.join(apart, "band").join(slim, "class").join(parities, "class"), "near-members", rows)
        if turn == ROUNDS:
            more = apart_pairs(members, percent)
        else:
            drawn = members.groupBy("band").agg(F.min(F.struct(F.xxhash64("band", "class", F.lit(turn)).alias("lot"), "class")).alias("drawn"))
            other = members.join(drawn.select("band", F.col("drawn.class").alias("class")), ["band", "class"])
            x, y = members.alias("x"), other.alias("y")
            more = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.root") != F.col("y.root")) & promising("x", "y") & may_overlap("x", "y", percent))
            more = more.select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct()
        more = stored(more.join(tested, ["a", "b"], "left_anti"), "near-pairs", rows)
        found = stored(_confirm(more, sets, percent), "near-more", rows)
        tested = tested.unionByName(more)
        if not found.isEmpty():
            links = links.unionByName(found)
            roots = components(links, rows)
    rooted = signed.join(roots, F.col("class") == F.col("node"), "left").select("doc_id", "text_key", "n_shingles", F.coalesce("root", "class").alias("root"))
    # Both sides of the last join are written out, so that the rows of a large component may be split among tasks.
    rooted = stored(rooted, "near-rooted", rows)
    named = stored(rooted.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id")), "near-named", rows)
    joined = rooted.join(named, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "text_key", "n_shingles", component.alias("component_id"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of every group, in the columns of ``docs``: the smallest ``doc_id``'s."""
    marked = near_duplicates(docs, size, percent).filter("doc_id <=> component_id").select("doc_id", "text_key").distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(row.alias("packed_row"), "doc_id", text_key(F.col("text")).alias("text_key"))
    kept = keyed.alias("d").join(marked.alias("m"), F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.text_key") == F.col("m.text_key")), "left_semi")
    return kept.dropDuplicates(["doc_id", "text_key"]).select("packed_row.*")
