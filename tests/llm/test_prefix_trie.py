"""The prefix trie against plain sets of prefixes."""

import hashlib
import random
import zlib

import pytest

from candlespark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, id int, block double"


def brute(rows):
    turns = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns.setdefault(conv_id, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts)] for c, ts in turns.items()}
    members, ends = {}, {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - c % 100, [])[:h] + ts[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], set()).add(c)
        ends.setdefault(path, []).append(c)
    children = {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    leaves, saved = {}, {}
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] = leaves.get(node[:d], 0) + (node not in children)
            saved[node[:d]] = saved.get(node[:d], 0) + (len(convs) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(
        [
            (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children.get(n, 0), leaves[n], saved[n],
             hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest())
            for n, m in members.items()
        ],
        key=str,
    )


def rows():
    rng = random.Random(2)
    say = lambda: rng.choice(["", "yes", "nö 𝄞", "tell me more", None, "</s>\n"])
    found = []
    for c in [*range(0, 60), *range(130, 150), 300, *range(3000, 3012), -7, -100, -250]:
        for turn in range(rng.randint(1, 9)):
            found.append((c, turn * rng.choice([1, 500]) if c < 20 else turn, rng.choice(["user", "assistant", None]), say()))
    for c in range(400, 440):
        found += [(c, i, "user", f"same {i}") for i in range(3)]
    found += [(500, i, "user", f"long {i}") for i in range(60)] + [(501, i, "user", f"long {i}") for i in range(59)]
    found += [(502, None, "user", "first"), (502, -5, "user", "second"), (502, 4000, "user", "third")]
    found += [(503, 1, "user", "twice")] * 2 + [(None, 0, "user", "nobody"), (None, None, None, None)]
    return found


@pytest.mark.parametrize("small", [False, True])
def test_trie(spark, monkeypatch, small):
    data = rows()
    if small:
        for name, value in {"TURNS": 2, "SIBLINGS": 1, "POSITIONS": 2, "IDS": 1, "SPREAD": 3, "DIRECT": 8}.items():
            monkeypatch.setattr(prefix_trie, name, value)
    got = prefix_trie.trie(spark.createDataFrame([(*r, "x", 1, 0.5) for r in data], SCHEMA).repartition(4)).collect()
    assert sorted(map(tuple, got), key=str) == brute(data)


def test_no_conversations(spark):
    for data in ([], [(None, 0, "user", "nobody", "x", 1, 0.5)]):
        assert prefix_trie.trie(spark.createDataFrame(data, SCHEMA)).count() == 0
