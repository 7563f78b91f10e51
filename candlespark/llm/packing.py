"""Best-fit packing of tokenised documents by bin completion.

Documents are tokenised where they lie; a longer one than ``capacity`` is cut into whole sequences and one shorter
first piece. Only the number of pieces per length is gathered (at most ``capacity`` rows). On these counts a
best-fit packing gives the incumbent; while it needs more sequences than the lower bound, bin completion searches
for a better one: the largest document left is completed by undominated fillings, tightest first, and a branch ends
when its waste leaves no room below the incumbent. Fillings are used as often as the counts allow, so the plan has
few rows whatever the data. Pieces then find their place by their rank among pieces of equal length; ranks come from
counts per length and hash block, so no task sees all pieces of a length.

Edge cases: null and empty texts are one end token. Repeated rows are packed one by one. A null ``doc_id`` is packed
like any other. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlespark.session import materialize

CAPACITY = 2048
END_ID = 0
BLOCKS = 256
CACHE_ROWS = 300_000
#: Steps of the search; a count, so that reruns agree.
NODES = 100
FILLINGS = 30

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class Encoder:
    """Token ids of texts as little-endian bytes.

    With ``ranks``, the same vocabulary as merge ranks, texts of plain Latin characters and no overlong word go whole a faster
    way to the same ids. The others go to the tokenizer: it always splits before a space that stands between two other
    characters, so a text with no other spaces is encoded stretch by stretch, and the stretches, mostly repeated words, are
    looked up. A text that holds one of the tokenizer's special strings is encoded whole, as the tokenizer reads it.
    """

    def __init__(self, path: str, ranks: str | None = None, cache_rows: int = CACHE_ROWS):
        import base64
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)").search
        self.odd_space = re.compile(r" \s|\s ").search
        self.plain = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ]*").fullmatch
        # The merges of the rank file take time with the square of a word's length.
        self.overlong = re.compile(r"[^\t\n\r ]{201}").search
        self.fast = None
        if ranks:
            import public_tokenizers
            import tiktoken

            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks, "rb"))}
            self.fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
        self.known: dict[str, bytes] = {}
        self.cache_rows, self.held = cache_rows, 0

    def _ids(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        return [np.asarray(e.ids, "<u4").tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.cache_rows or self.held > 64 * self.cache_rows:
            self.known.clear()
            self.held = 0
        done, whole, first, rest = {}, {}, {}, {}
        for i, text in enumerate(texts):
            if self.special(text):
                whole[i] = text
            elif self.fast and self.plain(text) and not self.overlong(text):
                done[i] = array("I", self.fast(text)).tobytes()
            elif self.odd_space(text):
                whole[i] = text
            else:
                first[i], *rest[i] = text.split(" ")
        new = list(set().union(*rest.values()) - self.known.keys())
        self.known.update(zip(new, self._ids([" " + w for w in new])))
        self.held += sum(map(len, new))
        done.update(zip([*whole, *first], self._ids([*whole.values(), *first.values()])))
        get = self.known.__getitem__
        return [done[i] + b"".join(map(get, rest.get(i, ()))) for i in range(len(texts))]


def pieces(docs: DataFrame, path: str, ranks: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32``."""

    def cut(batches: Iterator) -> Iterator:
        from zlib import crc32

        import pandas as pd

        encoder, end = Encoder(path, ranks), END_ID.to_bytes(4, "little")
        for batch in batches:
            rows = []
            # A few texts at a time, so that long ones do not pile up.
            for low in range(0, len(batch), 64):
                part = batch.iloc[low : low + 64]
                for doc, ids in zip(part.doc_id, encoder.encode([t or "" for t in part.text])):
                    ids += end
                    n = len(ids) // 4
                    first = (n - 1) % capacity + 1
                    begin, length = 0, first
                    for piece in range((n - 1) // capacity + 1):
                        rows.append((doc, piece, begin, length, crc32(ids[4 * begin : 4 * (begin + length)])))
                        begin, length = begin + length, capacity
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(cut, PIECES)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """The larger of total over capacity and the bound of Martello and Toth over all thresholds."""
    number, volume = [0] * (capacity + 2), [0] * (capacity + 2)
    for s in range(capacity, 0, -1):  # of lengths from s on
        n = counts.get(s, 0)
        number[s], volume[s] = number[s + 1] + n, volume[s + 1] + s * n
    best, half = -(-volume[1] // capacity), capacity // 2 + 1
    for k in range(1, capacity // 2 + 1):
        large, bins = number[capacity - k + 1], number[half] - number[capacity - k + 1]
        room = bins * capacity - (volume[half] - volume[capacity - k + 1])
        best = max(best, large + bins + max(0, -(-(volume[k] - volume[half] - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Best fit, longest first, on counts: ``(bins, {length: documents in each})``."""
    groups: dict[int, list[tuple[int, dict[int, int]]]] = {}
    rooms = 0  # bit r: there are bins with room r
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            fitting = rooms >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                bins, held = groups[room].pop()
                if not groups[room]:
                    rooms ^= 1 << room
            else:
                bins, held, room = -(-left // (capacity // size)), {}, capacity
            each = min(room // size, left)
            full = min(bins, left // each)
            parts = [(full, held | {size: each}, room - each * size)]
            if bins > full and held:
                parts.append((bins - full, held, room))
            for n, own, space in parts:
                groups.setdefault(space, []).append((n, own))
                rooms |= 1 << space
            left -= full * each
    return [g for group in groups.values() for g in group]


def fillings(counts: dict[int, int], room: int, waste: int, most: int) -> list[dict[int, int]]:
    """Fillings of ``room`` that leave at most ``waste`` and are not dominated, tightest first.

    A filling is dominated if a document outside it fits in place of a shorter one inside it, or beside it.
    """
    sizes = sorted((s for s in counts if s <= room), reverse=True)
    found: list[tuple[int, dict[int, int]]] = []
    steps = 0

    def walk(at: int, left: int, held: dict[int, int]) -> None:
        nonlocal steps
        steps += 1
        if steps > 40 * most or len(found) >= most:
            return
        rest = max(at, bisect_left(sizes, -left, key=lambda s: -s))
        if rest == len(sizes):
            if left <= waste:
                spare = {s for s in sizes if counts[s] > held.get(s, 0)}
                if not any(s + left >= t > s for s in held for t in spare):
                    found.append((left, dict(held)))
            return
        for i in range(rest, len(sizes)):
            s = sizes[i]
            for n in range(min(counts[s], left // s), 0, -1):
                held[s] = n
                walk(i + 1, left - n * s, held)
                del held[s]
            if steps > 40 * most or len(found) >= most:
                return

    walk(0, room, {})
    return [held for _, held in sorted(found, key=lambda x: (x[0], -max(x[1], default=0)))]


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[tuple[int, dict[int, int]]]:
    """A packing with as few bins as the search finds: ``(bins, {length: documents in each})``."""
    best = best_fit(counts, capacity)
    used, bound, total = sum(n for n, _ in best), lower_bound(counts, capacity), sum(s * n for s, n in counts.items())
    stack: list[tuple[dict[int, int], list]] = [(dict(counts), [])]
    while stack and used > bound and nodes:
        nodes -= 1
        left, plan = stack.pop()
        bins = sum(n for n, _ in plan)
        if not left:
            if bins < used:
                best, used = plan, bins
            continue
        # Every subproblem's own best-fit packing is an incumbent.
        rest = best_fit(left, capacity)
        if bins + sum(n for n, _ in rest) < used:
            best = plan + rest
            used = sum(n for n, _ in best)
        packed = total - sum(s * n for s, n in left.items())
        spare = (used - 1) * capacity - total - (bins * capacity - packed)
        if spare < 0 or bins + lower_bound(left, capacity) >= used:
            continue
        largest = max(left)
        others = left | {largest: left[largest] - 1}
        others = {s: n for s, n in others.items() if n}
        branches = []
        for held in fillings(others, capacity - largest, spare, FILLINGS) or ([{}] if capacity - largest <= spare else []):
            held = held | {largest: held.get(largest, 0) + 1}
            loss = capacity - sum(s * n for s, n in held.items())
            times = min(left[s] // n for s, n in held.items())
            times = min(times, spare // loss) if loss else times
            if times:
                after = {s: n for s in left if (n := left[s] - times * held.get(s, 0))}
                branches.append((after, [*plan, (times, held)]))
        stack.extend(reversed(branches))
    return best


def pack(docs: DataFrame, path: str, ranks: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``."""
    spark = docs.sparkSession
    cut = materialize(pieces(docs, path, ranks, capacity), "pack-pieces")
    cut = cut.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(BLOCKS)).cast("int"))
    per_block = cut.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_block.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # Bounded by the number of lengths.
    counts = {r.length: r.n for r in per_block.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = bin_completion({s: n for s, n in counts.items() if s < capacity}, capacity)
    if counts.get(capacity):
        plan.append((counts[capacity], {capacity: 1}))
    rows, used, sequence = [], dict.fromkeys(counts, 0), 0
    for bins, held in plan:
        offset = 0
        for size, each in held.items():
            rows.append((size, used[size], each, sequence, offset))
            used[size] += bins * each
            offset += each * size
        sequence += bins
    rows.sort()

    def settle(batches: Iterator) -> Iterator:
        import numpy as np

        lengths, firsts, each, sequences, offsets = (np.array(x, "int64") for x in zip(*rows))
        keys = (lengths << 48) + firsts
        for batch in batches:
            length, rank = batch.length.to_numpy(), batch["rank"].to_numpy()
            # The last plan row of this length that starts at or before the rank.
            at = np.searchsorted(keys, (length << 48) + rank, "right") - 1
            inside = rank - firsts[at]
            batch["sequence_id"] = sequences[at] + inside // each[at]
            batch["offset"] = offsets[at] + inside % each[at] * length
            yield batch.drop(columns=["rank"]).astype({"doc_id": "Int64"})

    if not rows:
        return spark.createDataFrame([], f"{PIECES}, sequence_id bigint, offset bigint")
    order = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = cut.withColumn("inner", F.row_number().over(order) - 1).join(starts.select("length", "block", "before"), ["length", "block"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("inner")).alias("rank"))
    return ranked.mapInPandas(settle, f"{PIECES}, sequence_id bigint, offset bigint")
