"""Repeated passages against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from wattline.llm import repeats


def brute(texts: dict[int, str | None]) -> dict[int, tuple[int, int, str]]:
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in texts.items()}
    seen, out = set(), {}
    for i in sorted(words):
        w, gone = words[i], set()
        for s in range(len(w) - repeats.WINDOW + 1):
            own = tuple(w[s : s + repeats.WINDOW])
            if own in seen:
                gone.update(range(s, s + repeats.WINDOW))
            seen.add(own)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def corpus() -> dict[int, str | None]:
    rng = random.Random(5)
    word = lambda n: [f"w{rng.randrange(n)}é" for _ in range(rng.randrange(5, 200))]
    passages = [word(900) for _ in range(6)]
    texts: dict[int, str | None] = {1: None, 2: "", 3: " \t\n", 4: "one two", 5: "same " * 300, 6: "same " * 21 + "x"}
    for i in range(10, 160):
        parts = word(3000)
        for _ in range(rng.randrange(3)):
            p = passages[rng.randrange(6)]
            a = rng.randrange(len(p))
            parts += p[a : a + rng.randrange(10, 60)] + word(5000)
        texts[i] = rng.choice([" ", "  ", " \n"]).join(parts)
    for i in range(200, 260):  # copies
        texts[i] = texts[10 + i % 7]
    texts[300] = "a b " * 400  # repeats within itself
    texts[301] = " ".join(f"w{i % 977}" for i in range(20_000))
    return texts


@pytest.mark.parametrize("group_rows", [repeats.GROUP_ROWS, 40])
def test_kept_words_equal_brute_force(spark, group_rows):
    texts = corpus()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {
        r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest())
        for r in repeats.without_repeats(docs, group_rows).collect()
    }
    assert got == brute(texts)


def test_passages_are_the_removed_words_and_columns_stay(spark):
    run = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"start {run} end", 7, "a"), (2, f"other {run}", 8, None), (3, "short", None, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, id string")
    found = {r.doc_id: r.asDict() for r in repeats.without_repeats(docs).collect()}
    assert [found[i]["n_words"] for i in (1, 2, 3)] == [7, 8, None]
    assert [found[i]["id"] for i in (1, 2, 3)] == ["a", None, "c"]
    assert found[2]["passages"][0].asDict() == {"first": 1, "end": 61} and found[2]["kept_text"] == "other"
    assert not found[1]["passages"] and found[1]["n_removed"] == 0 and found[1]["_n_words"] == 62


def test_null_and_repeated_ids_and_empty_tables(spark):
    run = " ".join(f"p{i}" for i in range(30))
    rows = [(None, run), (7, run + " x"), (7, run + " y"), (7, run + " y"), (9, run)]
    found = repeats.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    gone = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in found)
    # Of the two texts of id 7 the one whose hash is less keeps its words; equal rows fare alike.
    assert gone[0] == (0, 30, 30) and gone[4] == (9, 30, 30)
    assert sorted(g[2] for g in gone[1:4]) in ([0, 0, 30], [0, 30, 30])
    assert repeats.digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tree_nodes_are_common_prefixes():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 3, (200, 6))
    order, common = repeats.nodes(rows)
    for depth in range(7):
        node = repeats.at_depth(order, common, depth)
        names = {tuple(r[:depth]) for r in rows.tolist()}
        assert len(set(node)) == len(names) == len({(n, tuple(r[:depth])) for n, r in zip(node, rows.tolist(), strict=True)})
