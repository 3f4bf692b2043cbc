"""Ids and links on texts that upset weak hashes and special cases."""

from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattline.llm import minhash, mixing, packing, sharding, token_files, tokens
from wattline.llm.words import plain_words, span_hashes

SWAP = str.maketrans("ab", "ba")


def thue_morse(size: int) -> tuple[str, str]:
    """A word and its complement: powers of an odd base give both the same 64-bit sum."""
    word = "a"
    while len(word) < size:
        word += word.translate(SWAP)
    return word, word.translate(SWAP)


ONE, OTHER = thue_morse(2048)
ODD = [f"x <|endoftext|> y {ONE[:1024]} {OTHER[:1024]}", "<|EndOfText|>a<|startoftext|> b", "", None, f"{OTHER} {ONE}", " <|x|> it's"]


def test_word_hashes_have_no_structure():
    data, starts, ends, _ = plain_words([f"{ONE} {OTHER} {ONE} x{ONE[1:]}".encode()])
    found = span_hashes(data, starts, ends).tolist()
    assert found[0] == found[2] and len(set(found)) == 3


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize(("name", "lower"), [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_ids_equal_a_fresh_tokenizer(name, lower, plain):
    path = tokens.vocabulary_path(name)
    library = Tokenizer.from_file(path)
    if plain:
        library.encode_special_tokens = True
    want = [library.encode(t or "", add_special_tokens=False).ids for t in ODD]
    assert [x.tolist() for x in tokens.WordEncoder(path, lower, plain).encode(ODD)] == want


def test_queries_keep_the_ids_of_special_tokens(spark):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    words = Tokenizer.from_file(tokens.vocabulary_path("word_bpe_49k.json"))
    want = {i: len(words.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in enumerate(ODD)}
    assert {r.doc_id: r.length for r in packing.digest(docs).collect()} == want
    bytes_ = Tokenizer.from_file(tokens.vocabulary_path("byte_bpe_50k.json"))
    want = {i: len(bytes_.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in enumerate(ODD)}
    assert {r.doc_id: r.n_tokens for r in token_files.digest(spark, docs).collect()} == want


def test_documents_without_a_common_shingle_are_not_linked(spark):
    rows = [(1, f"p q r s {ONE}"), (2, f"p q r s {OTHER}"), (3, f"P q r s {ONE}")]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 2, 3: 1}


CLASHES = [
    "_rank", "RANK", "before", "_before", "Passed", "inner", "_s", "_block", "block", "Slot", "_slot", "release", "_release",
    "deadline", "_deadline", "of_source", "key", "bucket", "order", "shard", "bytes", "range", "sort_key", "_bucket", "window",
    "_window", "first", "_first", "from", "to", "base", "size", "number", "count", "sequence_id", "offset", "row_in_block",
]


def clashing(spark, extra=()):
    rows = [(i, f"text {i} " * (i % 7), "abc"[i % 3], *extra_of(i)) for i in range(60)]
    more = ", ".join(f"`{c}` int" for c in [*CLASHES, *extra])
    return spark.createDataFrame([r + tuple(7 for _ in extra) for r in rows], f"doc_id long, text string, source string, {more}")


def extra_of(i: int) -> tuple[int, ...]:
    return tuple(i * 100 + k for k in range(len(CLASHES)))


def test_no_internal_name_touches_a_users_column(spark):
    lower = {c.lower() for c in CLASHES}
    assert len(lower) == len(CLASHES)
    docs = clashing(spark)
    want = sorted(map(tuple, docs.collect()))
    for made in (
        mixing.mix(docs, block_rows=4), mixing.in_mixed_order(docs, block_rows=4), mixing.with_position(docs, "_position"),
        sharding.assign_shards(docs, 5),
    ):
        assert sorted(map(tuple, made.select(*docs.columns).collect())) == want
    pieces = docs.drop("source", "text").withColumns(
        {"piece": F.lit(0), "length": F.col("doc_id") % 9 + 1, "position": F.col("doc_id")}
    )
    want = sorted(map(tuple, pieces.collect()))
    for made in (packing.pack(pieces, 16), packing.pack_in_order(pieces, 16, 10)):
        assert sorted(map(tuple, made.select(*pieces.columns).collect())) == want
        added = made.columns[-2:]
        assert added == ["_sequence_id", "_offset"]
        places = sorted((r[added[0]], r[added[1]], r["length"]) for r in made.collect())
        for (s, o, n), (t, p, _) in zip(places, places[1:], strict=False):
            assert p == (o + n if s == t else 0)


def test_shards_are_written_once_and_read_back(spark):
    docs = spark.createDataFrame([(i, None if i == 3 else f"é{i} " * (i % 11)) for i in range(200)], "doc_id long, text string")
    found = sharding.digest(docs, 7).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
    for shard in range(7):
        own = sorted(r.slot for r in found if r.shard == shard)
        assert own == list(range(len(own)))
    total = [sum(r["size"] for r in found if r.shard == s) for s in range(7)]
    assert max(total) - min(total) <= 2 * max(r["size"] for r in found)
    assert sharding.digest(docs.limit(0), 7).count() == 0
    plan = sharding.assign_shards(docs, 7)._jdf.queryExecution().toString()
    assert plan.count("REPARTITION_BY_COL") + plan.count("rangepartitioning") >= 1
