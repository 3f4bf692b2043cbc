"""The prefix trie against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from wattline.llm import prefix_trie
from wattline.llm.slots import SlotTable

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int"


def brute(rows: list[tuple]) -> list[tuple]:
    original: dict[int, list] = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            original.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    original = {c: [(r, t) for _, r, t in sorted(x, key=lambda y: y[0])] for c, x in original.items()}
    built = {}
    for c in original:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = original.get(c - c % 5, [])[:h] + original[c][h:]
    members: dict[tuple, list[int]] = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, own in members.items():
        below = [m for m in members if m[: len(node)] == node]
        leaves = [m for m in below if not any(x[:-1] == m and x for x in members)]
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m)
        ends = ",".join(str(c) for c in sorted(own) if len(built[c]) == len(node))
        out.append((
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own),
            sum(bool(m) and m[:-1] == node for m in members), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def conversations() -> list[tuple]:
    rng = random.Random(8)
    rows: list[tuple] = [(None, 1, "user", "x", "n", 1), (64, None, None, None, None, None)]
    for c in [*range(60), 70, 71, 73, *range(100, 140)]:
        shared = c >= 100  # one opening for many
        for t in range(rng.randrange(1, 12)):
            text = f"hallo {t}" if shared and t < 6 else f"ü{rng.randrange(3)} {t}"
            rows.append((c, None if t == 0 and c % 7 == 0 else t, ("user", "assistant")[t % 2], text, "n", 1))
    rows += [(200, t, "user", f"long {t}", None, None) for t in range(40)]
    rows += [(201, t, "user", f"long {t}", None, None) for t in range(30)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_rows", [prefix_trie.SHARD_ROWS, 10])
def test_trie_equals_brute_force(spark, shard_rows, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 20)
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    turns = prefix_trie.rebuilt(prefix_trie.turns_of(df))
    found = sorted(map(tuple, prefix_trie.trie(turns, shard_rows).collect()), key=repr)
    assert found == brute(rows)


def test_repeated_rows_and_empty_tables(spark):
    rows = [(3, 1, "user", "a", None, None)] * 2 + [(4, 1, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, prefix_trie.digest(df).collect()), key=repr) == brute(rows)
    assert prefix_trie.digest(df.limit(0)).count() == 0


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 62, (20_000, 2)).astype(np.uint64), axis=0)
    table = SlotTable(keys[::2])
    assert sorted(table.slots(keys[::2]).tolist()) == list(range(10_000))
    assert (table.slots(keys[1::2]) == -1).all()
    assert SlotTable(keys[:0]).slots(keys[:3]).tolist() == [-1] * 3
    with pytest.raises(ValueError, match="repeat"):
        SlotTable(np.concatenate([keys[:2], keys[:1]]))
