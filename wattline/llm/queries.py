"""The registered queries of this subpackage, over whole tables, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import (
    alignment,
    minhash,
    mixing,
    neighbours,
    packing,
    prefix_trie,
    quality,
    repeats,
    sharding,
    token_files,
    topk,
    urls,
    warc,
)
from wattline.llm.shared import ship_package
from wattline.workspace import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_shifted_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.digest(table(spark, sf_dir, "embeddings"))


def op2_histogram_sort_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


def op3_block_pruned_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.digest(table(spark, sf_dir, "embeddings"))


def op4_warc_index_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(table(spark, sf_dir, "pages"), new_folder(spark, "warc"))


def op5_co_trained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time that is derived from their id: some minute of 2024."""
    minute = F.pmod(F.col("page_id") * 7919, F.lit(366 * 1440))
    fetched = F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.make_dt_interval(mins=minute.cast("int"))
    return pages.select("page_id", "url", fetched.alias("fetched_at"))


# Words of hosts that the derived list names, and the day of 2024 they are listed from.
LISTED_WORDS = {"casino": 30, "bets": 90, "win": 200, "free": 250}


def derived_entries(pages: DataFrame) -> DataFrame:
    """Dated list entries that grow with the pages: of the hosts' last three labels every fifth (by
    hash) as a domain, most of them removed and some listed again later; every 17th page's URL; words."""
    spark = pages.sparkSession
    number = lambda c, at: F.conv(F.substring(F.md5(c), at, 5), 16, 10).cast("long")
    host = urls.url_host(F.col("url"))
    domain = pages.select(F.substring_index(host, ".", -3).alias("pattern")).distinct()
    domain = domain.filter(F.col("pattern").isNotNull() & (number("pattern", 1) % 5 == 0))
    added = number("pattern", 6) % 300
    steps = F.array(
        F.struct(F.lit("add").alias("action"), added.alias("day")),
        F.struct(F.lit("remove").alias("action"), (added + 20 + number("pattern", 11) % 60).alias("day")),
        F.struct(F.lit("add").alias("action"), (added + 100 + number("pattern", 16) % 90).alias("day")),
    )
    domains = domain.select(F.lit("domain").alias("kind"), "pattern", F.inline(steps)).filter(
        (F.col("action") == "add") | (number("pattern", 21) % 4 != 0)
    )
    single = pages.filter("page_id % 17 = 0").select(
        F.lit("url").alias("kind"),
        urls.url_page(F.col("url")).alias("pattern"),
        F.lit("add").alias("action"),
        (F.col("page_id") % 200).alias("day"),
    )
    words = spark.createDataFrame(
        [("word", w, "add", d) for w, d in LISTED_WORDS.items()],
        "kind string, pattern string, action string, day long",
    )
    entries = domains.unionByName(single).unionByName(words)
    day = F.make_dt_interval(days=F.col("day").cast("int"))
    dated = F.expr("timestamp_ntz'2024-01-01 00:00:00'") + day
    return entries.select("kind", "pattern", "action", dated.alias("dated"))


def op6_temporal_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = urls.screen(page_captures(pages), derived_entries(pages), "url", "fetched_at")
    return judged.select("page_id", "host", "fetched_at", "active", "blocked", "kind", "pattern", "listed_at")


_HOST = r"""nullif(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '^www\.|\.$', '', 'g'), '')"""
_PAGE = r"""regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/+$', '')"""
_NUMBER = "('0x' || substr(md5(pattern), {}, 5))::BIGINT"
OP6_SQL = f"""
WITH captures AS (
  SELECT page_id, {_HOST} AS host, lower({_HOST} || {_PAGE}) AS page,
         make_timestamp((1704067200 + (page_id * 7919) % (366 * 1440) * 60) * 1000000) AS fetched_at
  FROM pages),
domains AS (
  SELECT DISTINCT array_to_string(string_split(host, '.')[-3:], '.') AS pattern
  FROM captures WHERE host IS NOT NULL),
chosen AS (SELECT pattern, {_NUMBER.format(6)} % 300 AS a FROM domains WHERE {_NUMBER.format(1)} % 5 = 0),
steps AS (
  SELECT 'domain' AS kind, pattern, 'add' AS action, a AS day FROM chosen
  UNION ALL
  SELECT 'domain', pattern, 'remove', a + 20 + {_NUMBER.format(11)} % 60 FROM chosen
  WHERE {_NUMBER.format(21)} % 4 <> 0
  UNION ALL
  SELECT 'domain', pattern, 'add', a + 100 + {_NUMBER.format(16)} % 90 FROM chosen
  UNION ALL
  SELECT 'url', page, 'add', page_id % 200 FROM captures WHERE page_id % 17 = 0
  UNION ALL
  SELECT 'word', w, 'add', d FROM (VALUES {", ".join(f"('{w}', {d})" for w, d in LISTED_WORDS.items())}) t(w, d)),
changes AS (
  SELECT kind, pattern, day, bool_and(action = 'add') AS listed FROM steps
  WHERE pattern <> '' GROUP BY ALL),
-- Without intervals: the last change of every pattern up to the capture tells whether it is active.
hits AS (
  SELECT c.page_id, x.kind, x.pattern, x.day, x.listed,
         row_number() OVER (PARTITION BY c.page_id, x.kind, x.pattern ORDER BY x.day DESC) AS newest
  FROM captures c JOIN changes x
    ON to_timestamp(1704067200 + x.day * 86400)::TIMESTAMP <= c.fetched_at
   AND ((x.kind = 'domain' AND (c.host = x.pattern OR ends_with(c.host, '.' || x.pattern)))
     OR (x.kind = 'url' AND c.page = x.pattern)
     OR (x.kind = 'word' AND list_contains(regexp_split_to_array(c.host, '[.\\-]'), x.pattern)))),
-- Listed since: the first addition after the last removal.
active AS (
  SELECT h.page_id, h.kind, h.pattern,
         (SELECT min(y.day) FROM changes y WHERE y.kind = h.kind AND y.pattern = h.pattern AND y.listed
            AND y.day <= h.day AND y.day > coalesce((SELECT max(z.day) FROM changes z WHERE z.kind = h.kind
              AND z.pattern = h.pattern AND NOT z.listed AND z.day <= h.day), -1)) AS since
  FROM hits h WHERE h.newest = 1 AND h.listed),
first AS (
  SELECT page_id, count(*) AS n, min((since, kind, pattern)) AS f FROM active GROUP BY page_id)
SELECT c.page_id, c.host, c.fetched_at, coalesce(f.n, 0)::INT AS active, f.n IS NOT NULL AS blocked,
       f.f[2] AS kind, f.f[3] AS pattern, to_timestamp(1704067200 + f.f[1] * 86400)::TIMESTAMP AS listed_at
FROM captures c LEFT JOIN first f USING (page_id)
"""


def op7_histogram_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(table(spark, sf_dir, "documents"))


def op8_pfair_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op9_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digest(spark, table(spark, sf_dir, "documents"))


def op10_hyperminhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_perfect_hash_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.digest(table(spark, sf_dir, "conversations"))


def op12_end_offset_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digest(table(spark, sf_dir, "documents"))


def op13_suffix_tree_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(table(spark, sf_dir, "documents"))


LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_shifted_hilbert_neighbours,
        op2_histogram_sort_shards,
        op3_block_pruned_topk,
        op4_warc_index_first,
        op5_co_trained_quality,
        op6_temporal_url_lists,
        op7_histogram_best_fit,
        op8_pfair_mixture,
        op9_repair_token_files,
        op10_hyperminhash_duplicates,
        op11_perfect_hash_prefix_trie,
        op12_end_offset_alignment,
        op13_suffix_tree_repeats,
    )
}

# Score and order by rank within all pairs of a query: brute force over the whole table.
OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# Checksums bit by bit, whole prefixes as text, and subtrees as all pairs of nodes.
OP11_SQL = """
WITH RECURSIVE ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
bits(conv_id, s, i, c) AS (
  SELECT conv_id, conv_id::VARCHAR, 0, 4294967295::BIGINT FROM ids
  UNION ALL
  SELECT conv_id, s, i + 1, CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END
  FROM (SELECT conv_id, s, i, CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr(s, i // 8 + 1, 1))::BIGINT) ELSE c END AS x
        FROM bits WHERE i < 8 * length(s))),
heads AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(c, 4294967295) % 9 AS h FROM bits WHERE i = 8 * length(s)),
turns AS (
  SELECT conv_id, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS name,
         strlen(coalesce(text, '')) AS size,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
rebuilt AS (
  SELECT conv_id, 0::BIGINT AS depth, NULL AS name, 0::BIGINT AS size FROM ids
  UNION ALL
  SELECT h.conv_id, t.n, t.name, t.size FROM heads h JOIN turns t ON t.conv_id = h.base AND t.n <= h.h
  UNION ALL
  SELECT t.conv_id, t.n - h.h + least(h.h, (SELECT count(*) FROM turns b WHERE b.conv_id = h.base)), t.name, t.size
  FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND t.n > h.h),
prefixes AS (
  SELECT conv_id, depth, size, coalesce(string_agg(name, ',') OVER (PARTITION BY conv_id ORDER BY depth), '') AS prefix,
         lead(depth) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS ends
  FROM rebuilt),
steps AS (
  SELECT *, lag(prefix) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM prefixes),
nodes AS (
  SELECT depth, prefix, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, min(size) AS size,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ids
  FROM steps GROUP BY depth, prefix),
children AS (SELECT parent AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent),
counted AS (SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (prefix)),
sums AS (
  SELECT a.prefix, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.size)::BIGINT AS saved
  FROM counted a JOIN counted b ON a.depth = 0 OR b.prefix = a.prefix OR starts_with(b.prefix, a.prefix || ',')
  GROUP BY a.prefix)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves,
       s.saved AS saved_tokens, sha256(c.ids) AS ends_sha256
FROM counted c JOIN sums s USING (prefix) LEFT JOIN counted p ON c.depth > 0 AND p.prefix = c.parent
"""

# Every window as text, numbered in order of its places.
OP13_SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (SELECT doc_id, words, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split),
windows AS (
  SELECT doc_id, word, i, CASE WHEN i + 19 <= len(words) THEN md5(array_to_string(words[i:i + 19], ' ')) END AS name
  FROM places),
later AS (
  SELECT *, name IS NOT NULL AND row_number() OVER (PARTITION BY name ORDER BY doc_id, i) > 1 AS again FROM windows),
covered AS (
  SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM later),
sums AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n,
         string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM covered GROUP BY doc_id)
SELECT s.doc_id, len(s.words)::BIGINT AS n_words, coalesce(sums.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(sums.kept, '')) AS kept_sha256
FROM split s LEFT JOIN sums USING (doc_id)
"""

LLM_ORACLES = {
    "op3_block_pruned_topk": OP3_SQL,
    "op6_temporal_url_lists": OP6_SQL,
    "op11_perfect_hash_prefix_trie": OP11_SQL,
    "op13_suffix_tree_repeats": OP13_SQL,
}
