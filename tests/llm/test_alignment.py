"""Cross-tokenizer alignment against brute force with the plain libraries."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from wattline.llm import alignment
from wattline.llm.tokens import PieceEncoder, vocabulary_path

A, B = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")


def unicode_bytes() -> dict[str, int]:
    seen = [b for b in range(256) if chr(b).isprintable() and b not in (32, 160, 173)]
    table = {chr(b): b for b in seen}
    for b in range(256):
        if b not in seen:
            table[chr(256 + len(table) - len(seen))] = b
    return table


def brute(rows: list[tuple[int, str | None]]) -> list[tuple]:
    library, model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    library.encode_special_tokens = True
    table = unicode_bytes()
    docs = []
    for doc, text in rows:
        a, b = [], []
        if text:
            a = library.encode(" " + text, add_special_tokens=False).ids
            b = model.encode(text)
        ba = [bytes(table[c] for c in library.id_to_token(i)) for i in a]
        bb = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(ba) != b" " + text.encode() or b"".join(bb) != b" " + text.encode():
            docs.append((doc, [], [], [], ""))
            continue
        span = lambda parts: [(sum(map(len, parts[:i])), sum(map(len, parts[: i + 1]))) for i in range(len(parts))]
        sa, sb = span(ba), span(bb)
        links = [(a[i], b[j]) for i, x in enumerate(sa) for j, y in enumerate(sb) if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, last = [], 0
        for c in cuts:
            own = [",".join(str(i) for i, s in zip(ids, spans, strict=True) if last < s[1] <= c) for ids, spans in ((a, sa), (b, sb))]
            groups.append("|".join(own))
            last = c
        docs.append((doc, a, b, links, ";".join(groups)))
    counts = Counter(p for d in docs for p in set(d[3]))
    best: dict[int, int] = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    return sorted(
        (d, len(a), len(b), text.count(";") + 1 if a else 0, len(links), sum(counts[p] == best[p[0]] for p in links),
         sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if a else "")
        for d, a, b, links, text in docs
    )


ROWS = [
    (1, "Hello world, it's 1234 naïve café"), (2, None), (3, ""), (4, " "), (5, "a  b\n\n c\t"), (6, "日本語 😀 test"),
    (7, "x <|endoftext|> y <s> </s> <unk> <0x41>"), (8, "▁ marked"), (9, "nul\x00byte"), (10, "Hello world, it's 1234 naïve café"),
    (11, "ééééé çouelle un éonierç le ch trement"), (12, "Hello worldly " * 30), (12, "other text of one id"), (13, "ﬁne ligature ½ é"),
]


@pytest.mark.parametrize("max_bytes", [None, 0])
def test_alignment_equals_brute_force(spark, max_bytes):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumnRenamed("x", "pairs").repartition(3)
    found = alignment.alignments(docs, A, B, max_bytes)
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert found.columns == cols
    assert sorted(map(tuple, found.collect())) == brute(ROWS)


def test_documents_of_the_tables_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("length(text) < 1500")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, alignment.digest(docs).collect())) == brute(rows)


def test_null_ids_clashing_columns_and_empty_tables(spark):
    schema = "doc_id long, text string, pairs int, row string, count int"
    docs = spark.createDataFrame([(None, "a b", 1, "r", 2), (None, "a b", 1, "r", 2)], schema)
    found = alignment.digest(docs).collect()
    assert len(found) == 2 and all(r.doc_id is None and r.n_a > 0 and r.count_sum == 2 * r.n_links for r in found)
    assert alignment.digest(docs.limit(0)).count() == 0
    links = alignment.token_links(alignment.aligned(docs, A, B)).collect()
    assert {r["count"] for r in links} == {2} and all(r.best for r in links)


def test_pieces_of_cut_texts_are_those_of_the_library():
    rng = random.Random(12)
    texts = ["", " ", "  ", "   a", "a   ", "a\n b\t\tc \n", "x▁y ▁", "<s> </s><unk> a", "é ½ x²", "a\xa0b", "日本 語", "é"]
    texts += ["".join(rng.choice(" \t\nabcdeTh.,<>s/é½") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    own = PieceEncoder(B)
    assert own.cuts
    assert [x.tolist() for x in own.encode(texts)] == sentencepiece.SentencePieceProcessor(model_file=B).encode(texts)
