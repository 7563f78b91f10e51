"""Removal of byte strings of a given length that occur more than once.

Every string of ``length`` bytes that also starts anywhere else is removed, in the same text or another one.

Sorting all suffixes moves a record per byte several times (see the README for the figures), so positions are
sampled, and named, by content instead of by remainders of a difference cover. The sample keeps the property that
the cover gives: two equal strings of ``length`` bytes hold a sampled position at the same distance from their start.

1. Sample: in each window of ``length`` bytes the position whose ``GRAM`` bytes have the smallest hash, the leftmost of
   equals. Positions whose gram is found nowhere else end here, and with them every window they stand for.
2. Name: the windows of one sampled position that start at neighbouring bytes form cells of up to ``CELL`` windows. A cell
   is named by the bytes all its windows have (the core), its place before the sampled position, and the few bytes
   left and right of the core. Cells with equal names are repeated as a whole; a core found once is not repeated.
3. Merge: where cells share a core and differ beside it, one cell of each name is taken apart into windows, each
   named by core, left and right bytes; windows whose name occurs twice are repeated.

Equal texts are one text for all this: they are removed whole if long enough. Names are hashes of 128 bits; a
sampled gram's hash of 64 bits only decides what is looked at further.

Edge cases: null texts are empty; a text shorter than ``length`` keeps all bytes. Repeated rows are copies of each
other, so they go whole. Extra columns are ignored. Memory of a task follows its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlespark.llm.common import stored
from candlespark.session import materialize

GRAM, CELL = 64, 32


def _tools(length: int):
    """Functions used inside tasks; built there, so that workers need no import of this package."""
    import numpy as np

    mask = (1 << 64) - 1
    bases = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
    chunk = 1 << 18
    span = length - GRAM + 1
    powers: dict[int, tuple] = {}

    def grown(n: int, base: int):
        have = powers.get(base)
        if have is None or len(have[0]) < n:
            size = max(2 * chunk, n)
            with np.errstate(over="ignore"):
                up, down = (np.multiply.accumulate(np.concatenate([np.ones(1, "uint64"), np.full(size - 1, x, "uint64")])) for x in (base, pow(base, -1, mask + 1)))
            powers[base] = have = (up, down)
        return have

    table = np.random.default_rng(7).integers(1, 2**63, 256, dtype="uint64")

    def prefix(body, base: int):
        _, down = grown(len(body) + 1, base)
        out = np.zeros(len(body) + 1, "uint64")
        np.cumsum(table[body] * down[: len(body)], out=out[1:])
        return out

    def hashed(sums, start, end, base: int):
        """Hash of the bytes from start to end (arrays)."""
        up, _ = grown(len(sums) + 1, base)
        x = (sums[end] - sums[start]) * up[start]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
        return x ^ (x >> np.uint64(32))

    def sliding_min(x):
        """Smallest of each ``span`` neighbours, by running minima from both ends of blocks."""
        n = len(x) - span + 1
        padded = np.full(-(-len(x) // span) * span, np.iinfo("uint64").max, "uint64")
        padded[: len(x)] = x
        blocks = padded.reshape(-1, span)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        return np.minimum(behind[:n], ahead[span - 1 : span - 1 + n])

    def sampled(body):
        """For chunks of a text: first window, sampled position of each window, gram hashes from that window on."""
        for low in range(0, len(body) - length + 1, chunk):
            part = body[low : low + chunk + length - 1]
            sums = prefix(part, bases[0])
            at = np.arange(len(part) - GRAM + 1)
            grams = hashed(sums, at, at + GRAM, bases[0])
            keyed = (grams >> np.uint64(20) << np.uint64(20)) | at.astype("uint64")
            yield low, (sliding_min(keyed) & np.uint64((1 << 20) - 1)).astype("int64"), grams

    return np, bases, prefix, hashed, sampled


def keyed(docs: DataFrame) -> DataFrame:
    body = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    return docs.select("doc_id", body.alias("body")).withColumn("text_key", F.xxhash64("body", F.length("body")))


def anchors(texts: DataFrame, length: int) -> DataFrame:
    """``text_key, gram, at`` of the sampled positions of every text."""

    def sample(batches: Iterator) -> Iterator:
        import pandas as pd

        np, _, _, _, sampled = _tools(length)
        def frame(held):
            keys, places = [h[0] for h in held], [h[2] for h in held]
            whole = {"text_key": np.repeat(np.array(keys, "int64"), [len(x) for x in places])}
            return pd.DataFrame(whole | {"gram": np.concatenate([h[1] for h in held]), "at": np.concatenate(places)})

        for batch in batches:
            held, size = [], 0
            for key, raw in zip(batch["text_key"], batch["body"]):
                for low, own, grams in sampled(np.frombuffer(raw, "uint8")):
                    place = np.unique(own)
                    held.append((key, grams[place].view("int64"), place + low))
                    size += len(place)
                if size > 50_000:
                    yield frame(held)
                    held, size = [], 0
            if held:
                yield frame(held)

    return texts.filter(F.length("body") >= length).select("text_key", "body").mapInPandas(sample, "text_key bigint, gram bigint, at bigint")


CELLS = "text_key bigint, core_a bigint, core_b bigint, start bigint, n int, lead int, left binary, right binary"


def cells(texts: DataFrame, length: int) -> DataFrame:
    """Cells of windows around the positions in ``at``: the first window's ``start``, ``lead`` windows after the cell's own start."""

    def build(batches: Iterator) -> Iterator:
        import pandas as pd

        np, bases, prefix, hashed, sampled = _tools(length)
        def frame(held):
            keys = np.repeat(np.array([h[0] for h in held], "int64"), [len(h[1]) for h in held])
            whole = {"text_key": keys}
            for i, name in enumerate(("core_a", "core_b", "start", "n", "lead"), 1):
                whole[name] = np.concatenate([h[i] for h in held])
            for i, name in ((6, "left"), (7, "right")):
                whole[name] = [x for h in held for x in h[i]]
            return pd.DataFrame(whole)

        for batch in batches:
            held, size = [], 0
            for key, raw, wanted in zip(batch["text_key"], batch["body"], batch["at"]):
                body, wanted = np.frombuffer(raw, "uint8"), np.unique(np.asarray(wanted, "int64"))
                sums = [prefix(body, base) for base in bases]
                for low, own, _ in sampled(body):
                    begins = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                    ends = np.r_[begins[1:], len(own)] - 1
                    place = own[begins] + low
                    keep = np.isin(place, wanted)
                    place, begins, ends = place[keep], begins[keep] + low, ends[keep] + low
                    if not len(place):
                        continue
                    # Cells count backwards from the sampled position.
                    near, far = (place - ends) // CELL, (place - begins) // CELL
                    times = far - near + 1
                    which = np.repeat(np.arange(len(place)), times)
                    number = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + near[which]
                    high = place[which] - CELL * number
                    base = high - CELL + 1
                    first, last = np.maximum(base, begins[which]), np.minimum(high, ends[which])
                    core = [(hashed(s, high, base + length, b) + number.astype("uint64") * np.uint64(b)).view("int64") for s, b in zip(sums, bases)]
                    left = [raw[x:y] for x, y in zip(first.tolist(), high.tolist())]
                    right = [raw[x:y] for x, y in zip((base + length).tolist(), (last + length).tolist())]
                    held.append((key, *core, first, (last - first + 1).astype("int32"), (first - base).astype("int32"), left, right))
                    size += len(first)
                if size > 20_000:
                    yield frame(held)
                    held, size = [], 0
            if held:
                yield frame(held)

    return texts.select("text_key", "body", "at").mapInPandas(build, CELLS)


def repeated_windows(texts: DataFrame, length: int) -> DataFrame:
    """``text_key, start, n``: n neighbouring windows from ``start`` on that occur elsewhere among different texts or places."""
    positions = materialize(anchors(texts, length), "repeat-anchors")
    rows = positions.count()
    # Copies of a text give the same position; only different texts or places count.
    grams = positions.groupBy("gram").agg(*[f("text_key").alias(f"{f.__name__}_key") for f in (F.min, F.max)], *[f("at").alias(f"{f.__name__}_at") for f in (F.min, F.max)])
    # Written out, so that the join below may split a gram that many texts share.
    grams = stored(grams.filter("min_key <> max_key OR min_at <> max_at").select("gram"), "repeat-grams", rows)
    wanted = positions.join(grams, "gram", "left_semi").groupBy("text_key").agg(F.collect_set("at").alias("at"))
    some = texts.filter(F.length("body") >= length).join(stored(wanted, "repeat-wanted", rows), "text_key")
    own = some.select("text_key", "body", "at").dropDuplicates(["text_key"])
    found = cells(own, length).withColumn("name", F.xxhash64("left", "right", "lead", "n")).withColumn("name_b", F.xxhash64(F.lit(1), "right", "left", "lead", "n"))
    found = materialize(found.withColumn("place", F.xxhash64("text_key", "start")), "repeat-cells")
    names = stored(found.groupBy("core_a", "core_b", "name", "name_b").agg(F.count("*").alias("times"), F.min("place").alias("chosen")), "repeat-names", rows)
    cores = names.groupBy("core_a", "core_b").agg(F.count("*").alias("kinds"))
    names = names.join(cores, ["core_a", "core_b"]).filter("times > 1 OR kinds > 1")
    met = stored(found.join(names, ["core_a", "core_b", "name", "name_b"]), "repeat-met", rows)
    whole = met.filter("times > 1").select("text_key", "start", "n")
    # One cell of each name, window by window.
    apart = met.filter("kinds > 1 AND place = chosen").withColumn("step", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    left = F.col("left").substr(F.col("step") + 1, F.length("left"))
    right_length = F.length("right") - (F.col("n") - 1 - F.col("step"))
    right = F.col("right").substr(F.lit(1), right_length)
    offset = F.col("lead") + F.col("step")
    windows = apart.select(
        "text_key", (F.col("start") + F.col("step")).alias("start"), (F.col("times") > 1).alias("known"),
        F.xxhash64("core_a", "core_b", offset, left, right).alias("window_a"), F.xxhash64(F.lit(1), right, left, offset, "core_b", "core_a").alias("window_b"),
    )
    windows = stored(windows, "repeat-windows", rows)
    twice = windows.groupBy("window_a", "window_b").agg(F.count("*").alias("times")).filter("times > 1")
    single = windows.filter("NOT known").join(twice, ["window_a", "window_b"], "left_semi")
    return whole.unionByName(single.select("text_key", "start", F.lit(1).alias("n")))


REMOVED = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>"


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """Per row what was removed, ``spans`` as byte ranges, and the digest of what is kept."""
    texts = keyed(docs.select(F.col("doc_id").cast("bigint"), "text"))
    windows = repeated_windows(texts, length).groupBy("text_key").agg(F.collect_list(F.struct("start", "n")).alias("windows"))
    copies = texts.groupBy("text_key").agg(F.count("*").alias("copies"))
    known = copies.join(windows, "text_key", "left").filter("copies > 1 OR windows IS NOT NULL")
    known = materialize(known, "repeat-known")

    def remove(batches: Iterator) -> Iterator:
        import hashlib

        import numpy as np
        import pandas as pd

        for batch in batches:
            rows = []
            for doc, raw, copies, found in zip(batch.doc_id, batch.body, batch.copies, batch.windows):
                n, spans = len(raw), []
                if copies > 1 and n >= length:
                    spans = [(0, n)]
                elif found is not None and len(found):
                    start = np.array([w["start"] for w in found], "int64")
                    end = start + np.array([w["n"] for w in found], "int64") - 1 + length
                    order = np.argsort(start, kind="stable")
                    start, reach = start[order], np.maximum.accumulate(end[order])
                    new = np.r_[True, start[1:] > reach[:-1]]
                    spans = list(zip(start[new].tolist(), reach[np.r_[np.flatnonzero(new)[1:] - 1, len(start) - 1]].tolist()))
                digest, at = hashlib.sha256(), 0
                for a, b in spans:
                    digest.update(raw[at:a])
                    at = b
                digest.update(raw[at:])
                rows.append((doc, n, sum(b - a for a, b in spans), len(spans), digest.hexdigest(), spans))
            columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
            yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

    joined = texts.join(known, "text_key", "left").select("doc_id", "body", F.coalesce("copies", F.lit(1)).alias("copies"), "windows")
    return joined.mapInPandas(remove, REMOVED)
