"""The operators against brute force and on odd input."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wattline.llm import (
    hilbert, minhash, mixing, neighbours, packing, quality, queries, shared, sharding, token_files, tokens,
    topk, urls, warc,
)
from wattline.workspace import new_folder

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, slot long"
LONG = " ".join(f"w{i % 977}" for i in range(9000))
ROWS = [
    (1, "one two three four five six", "en", "a", 27, 0, 0), (2, None, None, None, None, 0, 0),
    (3, "", "en", "a", 0, 0, 0), (4, "one two three four five six", "en", "b", 27, 0, 0),
    (5, LONG, "de", "a", len(LONG), 0, 0), (6, LONG + " end", "de", "b", 5, 0, 0), (7, "ONE two", "en", "b", 7, 0, 0),
    (8, "one two", "en", "a", 7, 0, 0), (9, "日本 語 é́ it's  we'll\n\n x² ", "ja", "c", 9, 0, 0), (9, "", "en", "a", 0, 0, 0),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, copies, a repeated id, and extra columns with clashing names."""
    return spark.createDataFrame(ROWS, DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def brute_components(texts: dict[int, str]) -> dict[int, int]:
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, text in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (find(i), len(sets[i])) for i in sets}


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(3)
    base = [f"v{rng.randrange(300)}" for _ in range(120)]
    texts = {1: None, 2: "", 3: "a b", 4: "A  b", 5: "a b c"}
    for i in range(10, 90):  # variants of one text, at many similarities
        words = list(base)
        for _ in range(rng.randrange(12)):
            words[rng.randrange(len(words))] = f"n{rng.random()}"
        texts[i] = " ".join(words[rng.randrange(5) :])
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    want = brute_components(texts)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(rows).collect()}
    assert {i: (r["component_id"], r["n_shingles"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_links_of_a_cell_join_what_is_similar_and_nothing_else():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 63, 500).astype(np.uint64))
    sets = [base, base[:450], base[:390], base[200:], np.unique(rng.integers(0, 1 << 63, 500).astype(np.uint64))]
    marks = np.stack([minhash.sketch(s) for s in sets])
    size, all_ = np.array(list(map(len, sets))), np.arange(5)
    keys = [bytes([i]) for i in range(5)]
    found = set()
    for band in range(minhash.BANDS):
        found |= set(minhash.linked_in_cell(keys, all_, size, marks, sets, all_, all_, band))
    assert {frozenset(k[0] for k in p) for p in found} <= {
        frozenset((i, j)) for i in range(5) for j in range(i) if minhash.linked(sets[i], sets[j])
    }
    assert {k for p in found for k in p} == {b"\0", b"\1", b"\2"}


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(2**bits)] * dims), -1).reshape(-1, dims)
        keys = hilbert.hilbert_keys(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def vectors(spark, n=900, dims=12):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=dims)]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(300)]  # copies of one vector
    odd = [(5001, None), (5002, [0.0] * dims), (5003, [float("nan")] * dims), (5004, [1.0]), (None, rows[3][1])]
    odd += [(5005, [None] * dims), (5006, [float("inf")] * dims), rows[7]]
    kinds = "vec_id long, embedding array<double>"
    return rows, spark.createDataFrame(rows + odd, kinds).repartition(5)


def test_nearest_neighbours_reach_the_recall(spark):
    rows, df = vectors(spark)
    found = neighbours.digest(df).collect()
    x, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    hits = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        want = ids[np.lexsort((ids, d))[:10]].tolist()
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert np.allclose([m[2] for m in mine], d[[m[1] for m in mine]])
        hits += len(set(want) & {m[1] for m in mine})
    assert hits >= 0.9 * 10 * 12
    assert neighbours.digest(df.limit(0)).count() == 0


def test_top_inner_products_are_exact(spark):
    rows, df = vectors(spark)
    found = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.digest(df).collect())
    rows = rows + [(5002, [0.0] * 12), rows[7]]
    x, ids = np.floor(256 * np.array([v for _, v in rows])), np.array([i for i, _ in rows])
    want = []
    for q in sorted({i for i in ids.tolist() if i % 50 == 0}):
        s = x @ x[ids == q][0]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:5]
        want += [(q, k + 1, int(ids[j]), int(s[j])) for k, j in enumerate(order)]
    assert found == want
    assert topk.digest(df.limit(0)).count() == 0


def test_shards_have_near_equal_bytes_and_gapless_slots(spark, sf, docs, nothing):
    rows = sharding.digest(spark.read.parquet(f"{sf}/documents.parquet").union(
        spark.read.parquet(f"{sf}/documents.parquet").withColumn("doc_id", F.col("doc_id") + 1000)
    )).collect()
    sizes, slots = {}, {}
    for r in rows:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    total, largest = sum(sizes.values()), max(r["size"] for r in rows)
    assert all(abs(n - total / 40) <= largest + 0.002 * total / 40 for n in sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    placed = sharding.assign_shards(docs, 3)
    assert placed.columns == [*docs.columns, "bytes", "_shard", "_slot"] and placed.count() == 10
    assert sharding.digest(nothing).count() == 0
    few = {(r["doc_id"], r["size"], r["text_crc32"]) for r in sharding.digest(docs).collect()}
    assert few == {(r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in ROWS}


@pytest.mark.parametrize("name,lower", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_ids_are_those_of_the_library(name, lower):
    encode = tokens.WordEncoder(tokens.vocabulary_path(name), lower)
    rng = random.Random(5)
    parts = ["'s", "'ll", "'", " ", "  ", "\n", "\t", "a", "É", "x²", "12", "!?", "日", "é", "<|endoftext|>", "\x1c", "ß", "'S"]
    texts = ["", None, " ", "'s's", "a 's", "\n\n", LONG] + ["".join(rng.choices(parts, k=12)) for _ in range(600)]
    want = [e.ids for e in encode.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in encode.encode(texts)] == want


def test_packing_fills_sequences_without_gap_or_overlap(docs, nothing):
    rows = packing.digest(docs).collect()
    bins, pieces = {}, {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault((r["doc_id"], r["ids_crc32"], r["piece"]), []).append(r)
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    encode = tokens.encoder(tokens.vocabulary_path("word_bpe_49k.json"), True)
    total = sum(len(x) + 1 for x in encode.encode([r[1] for r in ROWS]))
    assert sum(r["length"] for r in rows) == total
    assert len(bins) == -(-total // 2048)
    assert packing.digest(nothing).count() == 0


def test_plan_is_a_partition_of_all_ranks():
    rng = random.Random(4)
    for _ in range(30):
        histogram = {rng.randint(1, 64): rng.randint(1, 200) for _ in range(20)}
        room, ranks = {}, {n: [] for n in histogram}
        for length, first, end, sequence, offset in packing.plan_slots(histogram, 64):
            ranks[length] += range(first, end)
            for k in range(end - first):
                room.setdefault(sequence + k, []).append((offset, length))
        assert all(sorted(r) == list(range(histogram[n])) for n, r in ranks.items())
        for places in room.values():
            ends = [0, *[o + n for o, n in sorted(places)]]
            assert [o for o, _ in sorted(places)] == ends[:-1] and ends[-1] <= 64


def test_token_files_round_trip(spark, docs, nothing):
    folder = new_folder(spark, "test-tokens")
    path = tokens.vocabulary_path("byte_bpe_50k.json")
    files = token_files.write_token_files(docs, folder, path, False, 2)
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.read_token_files(files).collect())
    encode, want, start = tokens.encoder(path, False), [], 0
    for doc, text in sorted(((r[0], r[1]) for r in ROWS), key=lambda r: (r[0], r[1] or "")):
        ids = np.append(encode.encode([text])[0], np.uint16(2))
        want.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
        start += len(ids)
    assert got == sorted(want)
    for row in files.collect():
        file = token_files.TokenFile(row["uri"])
        whole, at = file.all_ids(), 0
        for i, n in enumerate(file.sizes.tolist()):
            assert (file.document(i) == whole[at : at + n]).all()
            at += n
    assert token_files.digest(spark, nothing).count() == 0


def test_grammar_compresses_and_expands():
    rng = np.random.default_rng(6)
    ids = rng.choice(50, 20_000, p=np.arange(50, 0, -1) / 1275)
    ids[5000:9000] = np.tile(ids[:100], 40)
    sizes = np.array([0, 5000, 1, 0, 9999, 5000])
    symbols, spans, rules = token_files.compress(ids, sizes, 50)
    assert len(symbols) < 0.7 * len(ids) and spans.sum() == len(symbols)
    lengths = token_files.expansion_lengths(rules, 50)
    assert (token_files.expand(symbols, rules, lengths, 50) == ids).all()
    assert len({tuple(r) for r in rules.tolist()}) == len(rules)
    # No pair within a document is frequent any more.
    uses = Counter()
    for a, n in zip(np.cumsum(spans) - spans, spans, strict=True):
        uses.update(zip(symbols[a : a + n - 1].tolist(), symbols[a + 1 : a + n].tolist()) if n else ())
    assert max(uses.values()) < token_files.LEAST_USES


def test_long_repeats_become_deep_rules():
    ids = np.concatenate([np.tile(np.arange(1000), 64), np.full(5000, 7)]).astype(np.uint32)
    symbols, spans, rules = token_files.compress(ids, np.array([0, *[1000] * 64, 5000]), 1000)
    lengths = token_files.expansion_lengths(rules, 1000)
    assert spans.tolist()[:65] == [0] + [1] * 64 and spans[65] < 16 and lengths.max() >= 1000
    assert (token_files.expand(symbols, rules, lengths, 1000) == ids).all()


def test_documents_are_read_by_their_bits(tmp_path):
    rng = np.random.default_rng(9)
    docs = [rng.integers(65_500, 65_536, n).astype(np.uint32) for n in (9001, 0, 1, 4003)]
    uri = f"file://{tmp_path}/a"
    (tmp_path / "a").write_bytes(b"".join(token_files.file_bytes([5, None, 6, 7], docs, 65_536)))
    file = token_files.TokenFile(uri)
    assert file.width == 17 and (file.all_ids() == np.concatenate(docs)).all()
    assert all((file.document(i) == d).all() for i, d in enumerate(docs))


def test_archives_round_trip(spark):
    pages = [(1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://b/", None), (4, "u", ""), (5, "v", LONG), (None, "w", "z")]
    pages += [(10 + i, "c", "same é") for i in range(200)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    index = warc.write_archives(df, new_folder(spark, "test-warc"))
    got = {r["page_id"]: r for r in warc.read_records(index).collect()}
    assert len(got) == len(pages)
    for page, url, html in pages:
        payload, r = (html or "").encode(), got[page]
        same = [p for p, _, h in pages if (h or "") == (html or "") and p is not None]
        stored = max(same) if same else None
        assert r["payload_bytes"] == len(payload) and r["payload_digest"] == warc.payload_digest(payload)
        assert (r["record_type"], r["refers_to"]) == (("response", None) if page == stored else ("revisit", stored))
        assert r["payload"] == (payload if page == stored else None) and r["url"] == (url or "")
    some = warc.read_records(index.filter("page_id in (5, 209)")).collect()
    assert {r["page_id"] for r in some} == {5, 209}
    assert warc.digest(df.limit(0), new_folder(spark, "test-warc")).count() == 0


def test_quality_on_held_out_labels(spark, docs, nothing):
    base = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    seen = labels.filter("doc_id % 3 <> 0")
    scored = quality.score_quality(base, quality.train_quality(base, seen))
    rows = scored.join(labels.filter("doc_id % 3 = 0"), "doc_id").select("keep", "quality").collect()
    assert sum(r["keep"] == (r["quality"] == 1) for r in rows) >= 0.98 * len(rows)
    assert sum(not r["keep"] for r in rows if r["quality"] == 1) <= 0.01 * len(rows)
    none = quality.train_quality(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert all(r["keep"] for r in quality.score_quality(docs, none).collect())
    model = quality.train_quality(base, labels)
    assert quality.score_quality(docs, model).count() == 10
    assert quality.score_quality(nothing, model).count() == 0


def test_mixture_stays_within_a_block_of_its_target(docs, nothing):
    rng = random.Random(8)
    for _ in range(20):
        blocks = {f"s{i}": rng.randint(1, 300) for i in range(rng.randint(1, 9))}
        weights = {s: rng.random() + 0.01 for s in blocks if rng.random() < 0.9}
        order = {}
        for p in mixing.plan_phases(blocks, weights, 64):
            turn = {x: (s, j) for s, xs in p.slots.items() for j, x in enumerate(xs)}
            count = dict.fromkeys(p.parts, 0)
            for slot in range(p.start, p.end):
                round_, x = divmod(slot - p.start, p.period)
                s, j = turn[x]
                order[slot] = (s, p.first_block[s] + round_ * p.parts[s] + j)
                count[s] += 1
                done = slot + 1 - p.start
                assert all(abs(n - done * p.parts[k] / p.period) < 1 for k, n in count.items())
        assert sorted(order) == list(range(sum(blocks.values())))
        assert sorted(order.values()) == sorted((s, i) for s, n in blocks.items() for i in range(n))
    mixed = mixing.mix(docs, {"a": 3.0, None: 1.0}, block_rows=2)
    assert mixed.columns == [*docs.columns, "block", "release", "deadline", "_slot", "row_in_block"]
    rows = mixed.collect()
    assert len(rows) == 10 and all(r["release"] <= r["_slot"] < r["deadline"] for r in rows)
    assert mixing.digest(nothing).count() == 0
    assert mixing.in_mixed_order(docs).columns == docs.columns


def test_mixture_keeps_the_exact_weights_at_any_length(spark):
    """Rounded to parts of 2,048, the rare source is more than a block off after 2,200 slots."""
    n, parts = 12_000, {"rare": 1, "often": 999}
    source = F.when(F.col("id") < 30, "rare").otherwise("often")
    docs = spark.range(n).select(F.col("id").alias("doc_id"), source.alias("source"))
    mixed = mixing.mix(docs, parts, block_rows=1)
    rows = sorted(mixed.collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in rows] == list(range(n))
    count, alone = dict.fromkeys(parts, 0), False
    for r in rows:
        s, i = r["source"], count[r["source"]]
        count[s] += 1
        done = r["slot"] + 1
        if not alone:
            assert all(abs(1000 * count[k] - done * w) < 1000 for k, w in parts.items()), done
            assert (r["block"], r["release"]) == (i, i * 1000 // parts[s])
            assert r["deadline"] == -(-(i + 1) * 1000 // parts[s])
        assert r["release"] <= r["slot"] < r["deadline"]
        alone = alone or count["often"] == n - 30 or count["rare"] == 30
    assert count == {"rare": 30, "often": n - 30}


def test_mixture_pieces_join_without_seam():
    rng = random.Random(9)
    for _ in range(40):
        blocks = {f"s{i}": rng.randint(1, 900) for i in range(rng.randint(1, 8))}
        weights = {s: rng.random() ** 3 + 1e-3 for s in blocks}
        for p in mixing.plan_phases(blocks, weights, 1):
            total = sum(weights[s] for s in p.parts)
            share = {s: weights[s] / total for s in p.parts}
            turn = {x: s for s, xs in p.slots.items() for x in xs}
            count = dict.fromkeys(p.parts, 0)
            for x in range(p.end - p.start):
                count[turn[x]] += 1
                assert all(abs(n - (x + 1) * share[s]) < 1 + 1e-9 for s, n in count.items())


def test_pipeline_sequences_follow_the_target_weights(spark, tmp_path):
    import corpus_pipeline

    sizes = {"a": 8000, "b": 2000, "c": 500}
    rows = [(s, i) for s, n in sizes.items() for i in range(n)]
    words = [f"w{i}" for i in range(20)]
    docs = [(k, " ".join(words[: 10 + k % 10]), "en", s) for k, (s, _) in enumerate(rows)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").repartition(7)
    stages = dict(corpus_pipeline.STAGES)
    mixed = stages["mixture"](spark, frame, None).repartition(5, F.xxhash64("doc_id"))  # order is lost
    packed = stages["packing"](spark, mixed, None).join(frame.select("doc_id", "source"), "doc_id").collect()
    assert len({r["doc_id"] for r in packed}) == len(docs)
    share = {s: n**0.5 for s, n in sizes.items()}
    share = {s: w / sum(share.values()) for s, w in share.items()}
    sequences, at = {}, {}
    for r in packed:
        sequences.setdefault(r["sequence_id"], {}).setdefault(r["source"], []).append(r["length"])
        at.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in at.values():
        ends = [0, *[o + n for o, n in sorted(places)]]
        assert [o for o, _ in sorted(places)] == ends[:-1] and ends[-1] <= 2048
    assert sorted(sequences) == list(range(len(sequences)))
    # The smallest share runs out last or first; before any source ends the targets hold.
    until = min(sizes[s] / share[s] for s in sizes) * 0.8
    spent, seen = dict.fromkeys(sizes, 0), 0
    for k in sorted(sequences):
        for s, lengths in sequences[k].items():
            spent[s] += len(lengths)
        seen = sum(spent.values())
        if 1024 <= seen <= until and k + 1 in sequences:
            window = seen
            assert all(abs(spent[s] / window - share[s]) < 0.15 for s in sizes), (k, spent)
    assert seen == len(docs)


@pytest.mark.parametrize("mixes", [True, False])
def test_packing_follows_the_order_that_the_mixture_stored(spark, tmp_path, mixes):
    """Sequences have the target shares from the start; without the mixture they do not."""
    import corpus_pipeline

    sizes = {"a": 6000, "b": 1500, "c": 375}
    names = [s for s, n in sizes.items() for _ in range(n)]
    frame = spark.createDataFrame(
        [(i, f"{'w ' * (10 + i % 10)}", "en", s) for i, s in enumerate(names)],
        "doc_id long, text string, lang string, source string",
    ).repartition(3, "source")
    stages = dict(corpus_pipeline.STAGES)
    frame.write.parquet(f"{tmp_path}/kept")
    docs = spark.read.parquet(f"{tmp_path}/kept")
    if mixes:
        stages["mixture"](spark, docs, None).write.parquet(f"{tmp_path}/mixed")
        docs = spark.read.parquet(f"{tmp_path}/mixed")
    packed = stages["packing"](spark, docs, None)
    assert packed.count() == len(names)
    found = sorted((r["sequence_id"], r["doc_id"]) for r in packed.collect())
    assert {k for k, _ in found} == set(range(found[-1][0] + 1))
    first = [names[i] for _, i in found][:2048]
    share = {s: n**0.5 for s, n in sizes.items()}
    even = all(abs(first.count(s) / len(first) - w / sum(share.values())) < 0.05 for s, w in share.items())
    assert even is mixes


def test_stored_position_is_the_order_of_writing(spark, tmp_path):
    rows = spark.range(5000).withColumn("_metadata", F.xxhash64("id")).repartition(4)
    ordered = rows.repartitionByRange(6, "_metadata").sortWithinPartitions("_metadata")
    ordered.write.option("maxRecordsPerFile", 300).parquet(f"{tmp_path}/rows")
    stored = spark.read.parquet(f"{tmp_path}/rows")
    found = stored.select("_metadata", shared.stored_position(stored).alias("at")).orderBy("at").collect()
    keys = [r["_metadata"] for r in found]
    assert keys == sorted(keys) and len({r["at"] for r in found}) == 5000
    pq.write_table(pa.table({"id": list(range(9))}), f"{tmp_path}/named.parquet")
    other = spark.read.parquet(f"{tmp_path}/named.parquet")
    assert len({r[0] for r in other.select(shared.stored_position(other)).collect()}) == 9
    assert shared.stored_position(rows) is None and shared.stored_position(stored.repartition(3)) is None


def test_pipeline_decides_repeated_ids_by_row(spark):
    """The unique text of a repeated id stays, its copy of an earlier document goes, wherever they lie."""
    import corpus_pipeline

    copied, own, other = (" ".join(f"{c}{i}" for i in range(30)) for c in "xyz")
    rows = [(1, copied), (7, copied), (7, own), (7, own), (7, own.upper()), (7, other), (8, None), (8, ""), (None, copied)]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").coalesce(1)
        after = [(r["doc_id"], r["text"]) for r in corpus_pipeline.without_near_duplicates(spark, docs, None).collect()]
        texts = sorted((i or 0, (t or "").lower()) for i, t in after)
        assert texts == [(0, copied), (1, copied), (7, own), (7, other), (8, "")]


def test_url_lists_hold_for_their_intervals(spark):
    captures = spark.createDataFrame(
        [(1, "https://www.x.bad.com/a/?q", 5), (2, "https://x.bad.com/", 15), (3, None, 5), (4, "http://ok.org/p/", 9),
         (5, "http://my-bets.net", 2), (6, "http://bad.com", None), (1, "https://www.x.bad.com/a/?q", 5)],
        "id int, url string, at int",
    )
    entries = spark.createDataFrame(
        [("domain", "bad.com", "add", 3), ("domain", "Bad.com", "add", 4), ("domain", "bad.com", "remove", 10),
         ("domain", "bad.com", "add", 10), ("url", "ok.org/p", "add", 9), ("word", "bets", "add", 3), ("word", "", "add", 0),
         (None, "x", "add", 1), ("domain", "ok.org", "remove", 1), ("domain", None, "add", 1)],
        "kind string, pattern string, action string, dated int",
    )
    got = sorted((r["id"], r["blocked"], r["kind"], r["listed_at"]) for r in urls.screen(captures, entries, "url", "at").collect())
    assert got == [
        (1, True, "domain", 3), (1, True, "domain", 3), (2, False, None, None), (3, False, None, None),
        (4, True, "url", 9), (5, False, None, None), (6, False, None, None),
    ]
    assert not any(r["blocked"] for r in urls.screen(captures, entries.limit(0), "url", "at").collect())
    assert urls.screen(captures.limit(0), entries, "url", "at").count() == 0


def test_url_lists_keep_columns_of_clashing_names(spark):
    names = ["id", "url", "at", "host", "KIND", "_page", "_active", "spans", "page", "found"]
    captures = spark.createDataFrame(
        [(1, "https://bad.com/a", 5, "h", "k", "p", "a", "s", "q", "f")],
        ", ".join(f"{n} {'int' if n in ('id', 'at') else 'string'}" for n in names),
    )
    entries = spark.createDataFrame([("domain", "bad.com", "add", 3)], "kind string, pattern string, action string, dated int")
    judged = urls.screen(captures, entries, "url", "at")
    assert judged.columns == [*names, "_host", "active", "blocked", "_kind", "pattern", "listed_at"]
    assert tuple(judged.first()) == (
        1, "https://bad.com/a", 5, "h", "k", "p", "a", "s", "q", "f", "bad.com", 1, True, "domain", "bad.com", 3,
    )


def test_queries_equal_their_sql(spark, sf):
    from compare import connect, differences

    for name, sql in queries.LLM_ORACLES.items():
        assert differences(queries.LLM_QUERIES[name](spark, sf), connect(sf), sql) is None, name


def test_pipeline_keeps_each_stage_s_promise(spark, sf, nothing, docs):
    import corpus_pipeline

    frame = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, frame, sf)
        assert after.columns == frame.columns, name
        ids = {r["doc_id"] for r in after.select("doc_id").collect()}
        if name == "near_duplicates":
            texts = {r["doc_id"]: r["text"] for r in frame.collect()}
            assert ids == {i for i, (root, _) in brute_components(texts).items() if i == root}
        if name == "mixture":
            assert after.count() == frame.count()
        frame = after
        assert stage(spark, nothing, sf).count() == 0
        stage(spark, docs, sf).count()
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()} == ids


def test_co_training_adds_up_over_all_unlabelled_rows(spark):
    rng = np.random.default_rng(5)
    docs = spark.createDataFrame(
        [(i, f"{'GOOD Text 12' if i % 2 else 'bad $$ ## @'} " * (1 + i % 7), "en", f"s{i % 3}", i) for i in range(3000)],
        "doc_id long, text string, lang string, source string, n_chars long",
    ).repartition(7)
    features = quality.described(docs)
    rows = features.collect()
    views = [np.array([r["t"] for r in rows]), quality.metadata_features(np.array([r["m"] for r in rows]))]
    label = (views[0][:, 0] > np.median(views[0][:, 0])).astype(float)
    models = [quality.Logistic.fitted(x[:200], label[:200]) for x in views]
    givers = [quality.Logistic(m.weights + rng.normal(0, 0.1, len(m.weights)), m.mean, m.spread) for m in models]
    for i, got in enumerate(quality.lent_sums(features, givers, models, 0.6)):
        odds = np.clip(givers[1 - i].log_odds(views[1 - i]), -30, 30)
        p = 1 / (1 + np.exp(-odds))
        sure = (p >= 0.6) | (p <= 0.4)
        assert np.allclose(got, models[i].sums(views[i][sure], (p[sure] >= 0.6).astype(float)), atol=1e-6)
    empty = quality.lent_sums(features.limit(0), givers, models, 0.6)
    assert not any(x.any() for x in empty)
