"""Removal of word windows that occurred before, found by Rabin-Karp hashes of every window.

1. Every window of ``size`` words of every text is hashed by two rolling polynomials over 64-bit word codes. One polynomial
   gives the window's key, the other one its bucket. A task keeps the windows of ``CHUNK`` words at a time, settles repeats inside
   that chunk, and ships each distinct window once: key, place in the chunk, document. A window that a third of all
   documents hold thus reaches its bucket once per chunk, not once per document.
2. Spark groups the windows by bucket. The number of buckets follows the input: one holds about ``BUCKET`` windows up to
   ``BUCKETS`` buckets, and up to ``FULL`` windows beyond, so that a chunk's share of a bucket stays worth a row. A bucket counts its keys; all windows of a repeated key but the earliest go back to their chunk.
3. A chunk merges the windows it gets back into maximal intervals per document, which are joined to the texts.

Keys are compared inside a bucket, so two different windows are taken for equal with chance 2^-64 per pair in a bucket: about
1e-13 for any one window, whatever the input.

Edge cases: null texts are empty; texts with fewer than ``size`` words keep all of them. Rows with one ``doc_id`` are one
document: a window is earlier only if its ``doc_id``, or at the same ``doc_id`` its start, is smaller, so repeated rows do
not remove each other. A null ``doc_id`` orders before all others. Extra columns are ignored, whatever their names. ``docs`` must be read
from storage, so that a recomputed task meets its rows in the same order. Memory of a task follows its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a chunk; windows of a bucket of small inputs, number of such buckets, windows of a bucket of large inputs.
CHUNK, BUCKET, BUCKETS, FULL = 1 << 20, 1 << 20, 1 << 12, 1 << 25

PIECES = "bucket bigint, chunk bigint, keys binary, places binary, run_docs binary, run_origins binary, run_marks binary, docs binary, repeats binary, twins binary"
REPEATS = "chunk bigint, docs binary, repeats binary, twins binary"
SPANS = "doc_id bigint, text_a bigint, text_b bigint, base bigint, spans binary"
REMOVED = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>"


def planes(values) -> bytes:
    """Differences of integers, all lowest bytes first: what Spark compresses well."""
    import numpy as np

    gaps = np.diff(np.asarray(values, "int64"), prepend=np.int64(0))
    return gaps.view("uint8").reshape(-1, 8).T.tobytes()


def values(raw: bytes):
    """The integers that ``planes`` wrote."""
    import numpy as np

    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, "uint8").reshape(8, -1).T).view("int64").ravel())


class Codes(dict):
    """64-bit codes of words; a bounded cache."""

    def __missing__(self, word: bytes) -> int:
        from hashlib import blake2b

        if len(self) >= 1 << 19:
            self.clear()
        code = self[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return code


class Rolling:
    """Hashes of all windows of ``size`` neighbouring codes, modulo 2^64, from prefix sums of ``code * base^i``."""

    def __init__(self, size: int, base: int):
        import numpy as np

        self.np, self.size, self.base, self.inverse = np, size, base, pow(base, -1, 1 << 64)
        self.up, self.down = self._powers(base, 1 << 12), self._powers(self.inverse, 1 << 12)

    def _powers(self, base: int, n: int):
        steps = self.np.full(n, base, "uint64")
        steps[0] = 1
        return self.np.cumprod(steps, dtype="uint64")

    def __call__(self, codes):
        np, n = self.np, len(codes)
        if n > len(self.up):
            self.up, self.down = self._powers(self.base, n + (n >> 3)), self._powers(self.inverse, n + (n >> 3))
        sums = np.zeros(n + 1, "uint64")
        np.multiply(codes, self.up[:n], out=sums[1:])
        np.cumsum(sums[1:], out=sums[1:])
        count = max(0, n - self.size + 1)
        return (sums[self.size : self.size + count] - sums[:count]) * self.down[:count]


def mixed(x):
    """A bijection of 64-bit numbers whose high bits depend on all bits."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def later(keys, docs, starts):
    """Indices ordered by key and place; for each the first of its key, and whether it lies behind that first."""
    import numpy as np

    order = np.lexsort((starts, docs, *keys))
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    return order, first, (docs[order] != docs[first]) | (starts[order] != starts[first])


def repeated(keys):
    """Indices of the values that occur more than once."""
    import numpy as np

    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    return order[np.r_[False, same] | np.r_[same, False]]


def chunk_rows(chunk: int, pieces: list, size: int, buckets: int, key_of, bucket_of) -> dict:
    """The rows of one chunk: its windows by bucket, and one row for the chunk itself, under a bucket below zero.

    ``pieces`` are ``(doc_id, text_a, text_b, base, codes)``, ``base`` being the place of the first code in its text.
    """
    import numpy as np

    lengths = np.array([len(p[4]) for p in pieces], "int64")
    offsets = np.cumsum(lengths) - lengths
    codes = np.concatenate([p[4] for p in pieces])
    meta = [np.array([p[i] for p in pieces], "int64") for i in range(4)]
    doc_ids, origins = meta[0], offsets - meta[3]
    counts = lengths - size + 1
    owner = np.repeat(np.arange(len(pieces)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[owner]
    keys = key_of(codes)[place]
    bucket = ((mixed(bucket_of(mixed(codes))[place]) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    bucket = bucket.astype("uint16" if buckets <= 1 << 16 else "uint32")
    met = repeated(keys)
    order, first, behind = later((keys[met], bucket[met]), doc_ids[owner[met]], (place - origins[owner])[met])
    equal = ~behind & (order != first)
    sent = np.ones(len(place), bool)
    sent[met[order[behind | equal]]] = False
    sent = np.flatnonzero(sent)
    sent = sent[np.argsort(bucket[sent], kind="stable")]
    cuts = np.flatnonzero(bucket[sent][1:] != bucket[sent][:-1]) + 1
    rows = {name.split()[0]: [] for name in PIECES.split(", ")}

    def add(**cells) -> None:
        for name in rows:
            rows[name].append(cells.get(name))

    for part in np.split(sent, cuts) if len(sent) else []:
        owners = owner[part]
        marks = np.diff(owners, prepend=-1) != 0
        runs = owners[marks]
        add(
            bucket=int(bucket[part[0]]), chunk=chunk, keys=keys[part].tobytes(), places=planes(place[part]), run_docs=planes(doc_ids[runs]),
            run_origins=planes(origins[runs]), run_marks=np.packbits(marks).tobytes(),
        )
    add(
        bucket=-1 - chunk, chunk=chunk, docs=planes(np.concatenate([*meta, lengths])), repeats=planes(np.sort(place[met[order[behind]]])),
        twins=planes(np.concatenate([place[met[first[equal]]], place[met[order[equal]]]])),
    )
    return rows


def hashed_windows(docs: DataFrame, size: int, buckets: int) -> DataFrame:
    """The windows of all texts, packed by chunk and bucket."""

    def build(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd
        from pyspark import TaskContext

        codes, rolls = Codes(), (Rolling(size, 0x9E3779B97F4A7C15), Rolling(size, 0xD1342543DE82EF95))
        chunk = TaskContext.get().partitionId() << 32
        pieces, held = [], 0
        for batch in batches:
            for doc_id, a, b, body in zip(batch["doc_id"], batch["text_a"], batch["text_b"], batch["body"]):
                tokens = body.split()
                for base in range(0, len(tokens) - size + 1, CHUNK):
                    part = tokens[base : base + CHUNK + size - 1]
                    pieces.append((doc_id, a, b, base, np.fromiter(map(codes.__getitem__, part), "uint64", len(part))))
                    held += len(part)
                    if held >= CHUNK:
                        yield pd.DataFrame(chunk_rows(chunk, pieces, size, buckets, *rolls))
                        pieces, held, chunk = [], 0, chunk + 1
        if pieces:
            yield pd.DataFrame(chunk_rows(chunk, pieces, size, buckets, *rolls))

    return docs.select("doc_id", "text_a", "text_b", "body").mapInPandas(build, PIECES)


def bucket_repeats(frame):
    """Of one bucket: per chunk the places of windows that are not the earliest of their key. A chunk's own row passes."""
    import numpy as np
    import pandas as pd

    if frame["bucket"].iloc[0] < 0:
        return frame[["chunk", "docs", "repeats", "twins"]]
    keys = np.concatenate([np.frombuffer(k, "uint64") for k in frame["keys"]])
    sizes = np.array([len(k) // 8 for k in frame["keys"]])
    met = repeated(keys)
    row = np.repeat(np.arange(len(sizes), dtype="int32"), sizes)[met]
    place = np.concatenate([values(p) for p in frame["places"]])[met]
    marks = np.concatenate([np.unpackbits(np.frombuffer(m, "uint8"), count=n) for m, n in zip(frame["run_marks"], sizes)])
    run = (np.cumsum(marks, dtype="int64") - 1)[met]
    docs = np.concatenate([values(r) for r in frame["run_docs"]])[run]
    starts = place - np.concatenate([values(r) for r in frame["run_origins"]])[run]
    order, _, behind = later((keys[met],), docs, starts)
    found = np.sort(order[behind])  # by row, and by place inside a row, as a stable sort left equal keys in any order
    found = found[np.lexsort((place[found], row[found]))]
    cuts = np.flatnonzero(np.diff(row[found])) + 1
    parts = np.split(found, cuts) if len(found) else []
    chunks = frame["chunk"].to_numpy()
    return pd.DataFrame({
        "chunk": [chunks[row[p[0]]] for p in parts], "docs": [None] * len(parts), "repeats": [planes(place[p]) for p in parts],
        "twins": [None] * len(parts),
    })


def merged(start, size: int):
    """Maximal runs of words covered by windows at the ascending places ``start``: first words and ends."""
    import numpy as np

    new = np.r_[True, np.diff(start) > size]
    return start[new], start[np.r_[np.flatnonzero(new)[1:] - 1, len(start) - 1]] + size


def chunk_spans(size: int):
    def spans(frame):
        import numpy as np
        import pandas as pd

        own = frame[frame["docs"].notna()].iloc[0]
        doc_ids, text_a, text_b, base, lengths = values(own["docs"]).reshape(5, -1)
        ends = np.cumsum(lengths)
        hit = np.zeros(int(ends[-1]), bool)
        for raw in frame["repeats"]:
            hit[values(raw)] = True
        kept, twin = values(own["twins"]).reshape(2, -1)
        hit[twin] |= hit[kept]
        place = np.flatnonzero(hit)
        owner = np.searchsorted(ends, place, side="right")
        rows = []
        for part in np.split(place, np.flatnonzero(np.diff(owner)) + 1) if len(place) else []:
            i = int(np.searchsorted(ends, part[0], side="right"))
            begin, end = merged(part - (ends[i] - lengths[i]) + base[i], size)
            rows.append((doc_ids[i], text_a[i], text_b[i], base[i], planes(np.stack([begin, end], 1).ravel())))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in SPANS.split(", ")])

    return spans


def repeated_spans(docs: DataFrame, size: int, buckets: int) -> DataFrame:
    """``doc_id, text_a, text_b, spans``: of each text with repeats the removed runs of its pieces."""
    later_windows = hashed_windows(docs, size, buckets).groupBy("bucket").applyInPandas(bucket_repeats, REPEATS)
    pieces = later_windows.groupBy("chunk").applyInPandas(chunk_spans(size), SPANS)
    # Repeated rows have the same runs: one is enough. The pieces of a text are few.
    once = pieces.dropDuplicates(["doc_id", "text_a", "text_b", "base"])
    return once.groupBy("doc_id", "text_a", "text_b").agg(F.sort_array(F.collect_list(F.struct("base", "spans"))).alias("found"))


def without(spans: DataFrame) -> DataFrame:
    """What is left of the texts of ``spans``."""

    def remove(batches: Iterator) -> Iterator:
        import hashlib

        import numpy as np
        import pandas as pd

        for batch in batches:
            rows = []
            for doc_id, none, body, found in zip(batch["doc_id"], batch["no_id"], batch["body"], batch["found"]):
                tokens, runs = body.split(), []
                for begin, end in np.concatenate([values(p["spans"]) for p in found]).reshape(-1, 2).tolist() if found is not None else []:
                    if runs and begin <= runs[-1][1]:
                        runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
                    else:
                        runs.append((begin, end))
                n = len(tokens)
                for begin, end in reversed(runs):
                    del tokens[begin:end]
                rows.append((None if none else doc_id, n, n - len(tokens), hashlib.sha256(b" ".join(tokens)).hexdigest(), runs))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in REMOVED.split(", ")[:4]] + ["spans"]).astype({"doc_id": "Int64"})

    return spans.mapInPandas(remove, REMOVED)


def remove_repeats(docs: DataFrame, size: int = 20) -> DataFrame:
    """Per row the number of words, how many are removed, the digest of the rest, and the removed runs of words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    least = F.lit(-(2**63)).cast("bigint")
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), least).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"),
        F.xxhash64(text).alias("text_a"), F.xxhash64(F.lit("b"), text).alias("text_b"), F.encode(text, "UTF-8").alias("body"),
    )
    size_of_all = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    windows = size_of_all // 5
    buckets = 1 + max(min(windows // BUCKET, BUCKETS), windows // FULL)
    joined = texts.join(repeated_spans(texts, size, buckets), ["doc_id", "text_a", "text_b"], "left")
    return without(joined.select("doc_id", "no_id", "body", "found"))
