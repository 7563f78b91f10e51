"""Removal of repeated word windows against a plain search."""

import hashlib
import random
import re

import numpy as np
import pytest

from candlespark.llm import token_windows

SCHEMA = "doc_id long, text string, spans string, bucket int, n_words double"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size):
    first, bodies = {}, []
    order = lambda i: (i is not None, i or 0)
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        bodies.append(words)
        for s in range(len(words) - size + 1):
            key, place = tuple(words[s : s + size]), (order(doc_id), s)
            first[key] = min(first.get(key, place), place)
    out = []
    for (doc_id, _), words in zip(rows, bodies):
        gone = set()
        for s in range(len(words) - size + 1):
            if first[tuple(words[s : s + size])] < (order(doc_id), s):
                gone.update(range(s, s + size))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((doc_id, len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def rows():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abéß, 　") for _ in range(rng.randint(1, 5))) for _ in range(400)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [prose(rng.randint(18, 60)) for _ in range(6)]
    found = []
    for i in range(60):
        words = prose(rng.randint(0, 50))
        for _ in range(rng.randint(0, 3)):
            words += rng.choice(passages) + prose(rng.randint(0, 25))
        found.append((rng.randint(-30, 60), rng.choice([" ", "\n", " \t", "\x0b\x0c\r"]).join(words)))
    copy = " ".join(prose(200))
    found += [(500 + i, copy) for i in range(20)] + [(500, copy), (500, copy)]
    found += [(None, copy), (None, copy), (None, " ".join(prose(30) + passages[0])), (None, None), (None, "")]
    found += [(600, None), (601, ""), (602, " \n "), (603, "a " * 19), (604, "a " * 300), (605, "a b " * 90), (606, " ".join(vocabulary * 8))]
    found += [(700, " ".join(passages[1] + prose(5))), (700, " ".join(prose(5) + passages[1])), (700, " ".join(passages[1] + prose(5)))]
    return found


@pytest.mark.parametrize(("chunk", "buckets"), [(1 << 20, 1 << 21), (150, 40)])
def test_removed_words(spark, monkeypatch, chunk, buckets):
    monkeypatch.setattr(token_windows, "CHUNK", chunk)
    monkeypatch.setattr(token_windows, "BUCKET", buckets)
    data = rows()
    frame = spark.createDataFrame([(*r, "x", 1, 0.5) for r in data], SCHEMA).repartition(5)
    got = token_windows.remove_repeats(frame, 20).collect()
    assert sorted((tuple(r[:4]) for r in got), key=str) == brute(data, 20)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)
    assert all(a.end < b.start for r in got for a, b in zip(r.spans, r.spans[1:]))


def test_no_documents(spark):
    assert token_windows.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rolling_hashes_equal_their_definition():
    codes = np.random.default_rng(1).integers(0, 2**64, 9000, dtype="uint64")
    base = 0x9E3779B97F4A7C15
    found = token_windows.Rolling(20, base)(codes)
    for i in (0, 1, 4000, len(codes) - 20):
        assert int(found[i]) == sum(int(c) * base**k for k, c in enumerate(codes[i : i + 20])) % 2**64
    assert len(found) == len(codes) - 19 and len(token_windows.Rolling(20, base)(codes[:19])) == 0


def test_planes_round_trip():
    for numbers in ([], [5], [-(2**63), 2**63 - 1, 0, -1]):
        assert token_windows.values(token_windows.planes(numbers)).tolist() == numbers
