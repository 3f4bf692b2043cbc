"""URL filters over dated lists. DataFrame functions only.

List entries say from when a pattern is listed or no longer listed. They become validity intervals;
every capture is judged by the entries that were active when it was fetched.

Patterns: ``domain`` (that host and all below it), ``word`` (a part of the host between dots or
hyphens) and ``url`` (host and path, without scheme, ``www.``, query, fragment and closing slash).

Intervals of a host are gathered once per distinct host and those of a URL once per distinct URL, so
a capture is joined as one row, never repeated per pattern; a hot host is left to the skew handling
of adaptive execution. What is gathered per host is bounded by the history of the lists.

Defined results: entries with a null or empty pattern, kind, action or date are void; of entries for
one pattern and instant a removal wins; listing what is listed, and removing what is not, changes
nothing; intervals contain their start and not their end. A capture without URL or time matches
nothing and is kept. Repeated captures give repeated rows. Empty lists block nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.shared import free_name

KINDS = ("domain", "word", "url")
ADDED = ("host", "active", "blocked", "kind", "pattern", "listed_at")


def url_host(url: Column) -> Column:
    """Lower-case host without user, port and a leading ``www.``; null where there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.nullif(F.regexp_replace(host, r"^www\.|\.$", ""), F.lit(""))


def url_page(url: Column) -> Column:
    """Host and path in the form that ``url`` patterns have."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    return F.concat(url_host(url), F.regexp_replace(path, "/+$", ""))


def validity(entries: DataFrame) -> DataFrame:
    """Intervals (kind, pattern, since, until) from entries (kind, pattern, action, dated).

    Actions are ``add`` and ``remove``; ``until`` is null while the entry stays listed.
    """
    pattern = F.lower(F.trim("pattern"))
    sound = F.col("kind").isin(*KINDS) & F.col("action").isin("add", "remove") & (pattern != "")
    changes = (
        entries.filter(sound & F.col("dated").isNotNull())
        .groupBy("kind", pattern.alias("pattern"), "dated")
        .agg(F.min(F.col("action") == "add").alias("listed"))
    )
    history = Window.partitionBy("kind", "pattern").orderBy("dated")
    turns = changes.withColumn("was", F.lag("listed", 1, False).over(history)).filter(
        F.col("listed") != F.col("was")
    )
    return (
        turns.withColumn("until", F.lead("dated").over(history))
        .filter("listed")
        .select("kind", "pattern", F.col("dated").alias("since"), "until")
    )


def _gathered(hits: DataFrame, key: str) -> DataFrame:
    span = F.struct("since", "until", "kind", "pattern")
    return hits.groupBy(key).agg(F.array_sort(F.collect_set(span)).alias("spans"))


def screen(captures: DataFrame, entries: DataFrame, url: str, fetched_at: str) -> DataFrame:
    """Every capture with ``host``, ``active`` (how many entries were active for it), ``blocked``,
    and the kind, pattern and start of the one listed first. All columns of ``captures`` are returned;
    added columns get a leading underscore where names clash."""
    spans = validity(entries)
    taken, names = list(captures.columns), {}
    for n in (*ADDED, "page", "host_spans", "page_spans", "found"):
        names[n] = free_name(taken, n)
        taken.append(names[n])
    host, page, host_spans, page_spans, found = (
        names[n] for n in ("host", "page", "host_spans", "page_spans", "found")
    )
    seen = captures.withColumns({host: url_host(F.col(url)), page: url_page(F.col(url))})

    labels = F.split("host", r"\.")
    tails = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    named = lambda kind: lambda p: F.struct(F.lit(kind).alias("kind"), p.alias("pattern"))
    patterns = F.concat(
        F.transform(tails, named("domain")),
        F.transform(F.array_distinct(F.split("host", r"[.\-]")), named("word")),
    )
    hosts = seen.select(F.col(host).alias("host")).filter("host is not null").distinct()
    by_host = _gathered(
        hosts.select("host", F.inline(patterns)).join(spans, ["kind", "pattern"]), "host"
    ).select(F.col("host").alias(host), F.col("spans").alias(host_spans))
    by_page = _gathered(
        spans.filter("kind = 'url'").withColumn("page", F.col("pattern")), "page"
    ).select(F.col("page").alias(page), F.col("spans").alias(page_spans))

    nothing = F.array().cast(by_host.schema[host_spans].dataType)
    at = F.col(fetched_at)
    active = F.filter(
        F.concat(F.coalesce(host_spans, nothing), F.coalesce(page_spans, nothing)),
        lambda x: (x.since <= at) & (x.until.isNull() | (at < x.until)),
    )
    first = F.array_min(found)
    return (
        seen.withColumn(page, F.lower(page))
        .join(by_host, host, "left")
        .join(by_page, page, "left")
        .withColumn(found, active)
        .select(
            *captures.columns,
            host,
            F.size(found).alias(names["active"]),
            (F.size(found) > 0).alias(names["blocked"]),
            first.kind.alias(names["kind"]),
            first.pattern.alias(names["pattern"]),
            first.since.alias(names["listed_at"]),
        )
    )
