"""Line dedup by site-relative frequency.

Per host, the share of its distinct texts that hold a line; lines whose share is over
the boilerplate ratio (and that at least ``min_pages`` of these texts hold) go. Copies
of a text count once, in the line's texts and in the host's: a page that a host serves
many times does not turn its own lines into boilerplate. Near copies count each.

Every text gives each of its distinct lines once, as a 128-bit hash. Texts are told
apart by a hash too: one combinable pick per (host, text) carries the line hashes, then
one combinable count per (host, line). A host whose pages hold L lines on
average has at most L / ratio lines over the ratio, however many pages it has:
the flagged lines of a host therefore fit one row, and pages meet that row in a
join on the host. Page texts are never shuffled for counting; they are only if
the host table is over Spark's broadcast threshold, and then AQE splits hot hosts.

Defined cases: lines end at line feeds; lines are compared with surrounding blanks
and tabs cut off, and lines that are then empty are left alone. A null host is a
host of its own. A null text stays null, an empty one empty; each counts as one text
of its host. Extra columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored

RATIO = 0.065  # sf0.1: ordinary lines are in up to 4.6 % of a host's texts, the repeated line in 8.7 % at least
MIN_PAGES = 2  # a line of one text is that text's own, however small the host


def host_of(url: Column) -> Column:
    """The lower-case host of a URL (null if there is none)."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def _key(line: Column) -> Column:
    return F.unhex(F.md5(F.trim(line, F.lit(" \t\r"))))


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def boilerplate_lines(pages: DataFrame, host_col: str = "source", text_col: str = "text",
                      ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Lines over the ratio: host, line_key, pages, host_pages (both without copies), share."""
    blank = F.unhex(F.md5(F.lit("")))
    own = pages.select(F.col(host_col).alias("host"), F.unhex(F.md5(F.col(text_col))).alias("text_key"),
                       F.array_distinct(F.transform(_lines(text_col), _key)).alias("keys"))
    totals = own.select("host", "text_key").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    texts = own.groupBy("host", "text_key").agg(F.first("keys").alias("keys"))  # equal texts have equal lines
    counts = (texts.select("host", F.explode("keys").alias("line_key")).where(F.col("line_key") != blank)
              .groupBy("host", "line_key").agg(F.count(F.lit(1)).alias("pages"))
              .where(F.col("pages") >= F.lit(min_pages)))
    return (counts.join(totals, counts["host"].eqNullSafe(totals["host"]))
            .select(counts["host"], "line_key", "pages", "host_pages",
                    (F.col("pages") / F.col("host_pages")).alias("share"))
            .where(F.col("share") > F.lit(ratio)))


def drop_boilerplate(pages: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, dropped_col: str | None = None) -> DataFrame:
    """``pages`` without its hosts' boilerplate lines; ``dropped_col`` adds how many lines went."""
    host, flagged, hits, lines, kept = fresh(pages, "host_", "flagged_", "hits_", "lines_", "kept_")
    per_host = stored(
        boilerplate_lines(pages, host_col, text_col, ratio, min_pages)
        .groupBy("host").agg(F.collect_list("line_key").alias("keys")), "boilerplate")
    sites = per_host.select(F.col("host").alias(host), F.col("keys").alias(flagged))
    joined = pages.join(sites, pages[host_col].eqNullSafe(F.col(host)), "left")
    split = joined.withColumn(lines, _lines(text_col))
    # the page's own flagged lines, by hash sets; then each line against those few
    split = split.withColumn(hits, F.when(F.col(flagged).isNotNull(), F.array_intersect(
        F.transform(F.col(lines), _key), F.col(flagged))))
    split = split.withColumn(kept, F.when(
        F.size(hits) > 0, F.filter(F.col(lines), lambda x: ~F.array_contains(F.col(hits), _key(x)))
    ).otherwise(F.col(lines)))
    out = [F.when(F.size(hits) > 0, F.array_join(kept, "\n")).otherwise(F.col(text_col)).alias(c)
           if c == text_col else F.col(c) for c in pages.columns]
    if dropped_col:
        out.append(F.coalesce(F.size(lines) - F.size(kept), F.lit(0)).alias(dropped_col))
    return split.select(*out)
