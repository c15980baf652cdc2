"""Line dedup by site-relative frequency.

Pages are grouped by host. A line's ratio is the number of the host's pages that contain it (once per
page, however often it stands there) over the number of all the host's pages. A line is boilerplate of the host, and goes,
if its ratio exceeds ``ratio`` by more than chance would have it: the score test of "the ratio is ``ratio``" at ``z`` standard
errors rejects, ``(k - ratio n)^2 > z^2 ratio (1 - ratio) n``. The bound follows the host's size (of 2 pages 2, of 9 pages 3, of
100 pages 16, of 10,000 pages 1,059 at the defaults), and there is no host too small to have boilerplate, but one: a line of
a single page repeats nothing. Lines are compared without white space (ASCII) at their ends; blank lines stay.

Built from DataFrame functions alone. Lines travel as 128-bit hashes, counted before they are
shuffled; only pages with a boilerplate line are named by the join that changes texts. A host with a
third of all pages is spread by line, then by page.

Null text stays null; a null host and an empty one are one host. Repeated rows are pages of their own
(each counts, each is kept and cut alike). Extra columns pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martsmith.llm.common import fingerprint128, fresh, staged, table


def host_of(url: Column) -> Column:
    """Host of a URL in lower case; null if it has none."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


SPACE = " \t\x0b\x0c\r"


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE))


def _key(line: Column) -> Column:
    return F.array(*fingerprint128(_bare(line)))


def _keys(text: Column) -> Column:
    """The different non-blank lines of a page, as hashes."""
    return F.array_distinct(F.transform(F.filter(_lines(text), lambda x: _bare(x) != ""), _key))


def boilerplate(pages: DataFrame, ratio: float = 0.1, z: float = 1.96, copies_once: bool = False) -> DataFrame:
    """(host, line, n_pages, host_pages): the boilerplate lines (as hashes) of ``pages`` (host, text); with ``copies_once``
    a host's pages of one text count as one page."""
    named = ["host", F.array(*fingerprint128(F.col("text"))).alias("page")] if copies_once else ["host"]
    heads, lines = pages.select(*named), pages.select(*named, F.explode(_keys(F.col("text"))).alias("line"))
    if copies_once:
        heads, lines = heads.distinct(), lines.distinct()
    totals = heads.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    counts = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_pages")).where("n_pages > 1")
    above = F.col("n_pages") - F.lit(ratio) * F.col("host_pages")
    return counts.join(totals, "host").where((above > 0) & (above * above > F.lit(z * z * ratio * (1 - ratio)) * F.col("host_pages")))


def dedup_lines(docs: DataFrame, host: Column | str = "source", id_col: str = "doc_id", text_col: str = "text",
                ratio: float = 0.1, z: float = 1.96, max_broadcast_rows: int = 500_000, copies_once: bool = False) -> DataFrame:
    """``docs`` with ``text_col`` cut, and the longs ``n_lines`` and ``n_dropped`` (with underscores put before
    them if ``docs`` has such columns). ``copies_once`` counts the copies of one text on a host as one page when lines are judged: the copies alone
    make no line boilerplate (they are a matter for document dedup, and cutting would lose them all), and a page that
    holds nothing but other pages' boilerplate is cut like any other."""
    host = F.coalesce((F.col(host) if isinstance(host, str) else host).cast("string"), F.lit(""))
    own = docs.select(host.alias("host"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    bad = staged(boilerplate(own, ratio, z, copies_once).select("host", "line"), "boilerplate")
    if bad.count() <= max_broadcast_rows:
        bad = F.broadcast(bad)
    page = F.array(*fingerprint128(F.col("text")))
    hit = own.select("host", "id", page.alias("page"), F.explode(_keys(F.col("text"))).alias("line")).join(
        bad, ["host", "line"]).groupBy("host", "id", "page").agg(F.collect_set("line").alias("drop"))
    of_host, of_id, of_page, drop, n_lines, n_dropped = (fresh(docs.columns, x) for x in (
        "of_host", "of_id", "of_page", "drop_lines", "n_lines", "n_dropped"))
    hit = hit.select(F.col("host").alias(of_host), F.col("id").alias(of_id), F.col("page").alias(of_page), F.col("drop").alias(drop))
    both = docs.join(hit, (host == hit[of_host]) & docs[id_col].eqNullSafe(hit[of_id])
                     & (F.array(*fingerprint128(docs[text_col])) == hit[of_page]), "left")
    lines = _lines(F.col(text_col))
    kept = F.filter(lines, lambda x: ~F.array_contains(F.col(drop), _key(x)))
    cut = F.col(drop).isNotNull()
    text = F.when(cut, F.array_join(kept, "\n")).otherwise(F.col(text_col))
    counts = [F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long").alias(n_lines),
              F.when(cut, F.size(lines) - F.size(kept)).otherwise(0).cast("long").alias(n_dropped)]
    return both.select(*[text.alias(c) if c == text_col else docs[c] for c in docs.columns], *counts)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, n_chars and text_sha256 (of the text that is left) of every document."""
    got = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return got.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("n_chars"),
                      F.sha2("text", 256).alias("text_sha256"))


# A row is a page, whatever its id. The threshold is stated in the score test's other form, with a root.
OP9_SQL = """
WITH pages AS (
  SELECT row_number() OVER () AS page, doc_id, coalesce(source, '') AS host, text FROM documents
), lines AS (
  SELECT page, host, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM pages WHERE text IS NOT NULL
), bare AS (
  SELECT *, regexp_replace(line, '^[\\x09-\\x0D\\x20]+|[\\x09-\\x0D\\x20]+$', '', 'g') AS key FROM lines
), hosts AS (
  SELECT host, count(*) AS host_pages FROM pages GROUP BY 1
), bad AS (
  SELECT b.host, key FROM bare b JOIN hosts h ON b.host = h.host
  WHERE key <> ''
  GROUP BY 1, 2, host_pages
  HAVING count(DISTINCT page) > 1
     AND (count(DISTINCT page) / host_pages - 0.1) / sqrt(0.1 * 0.9 / host_pages) > 1.96
), cut AS (
  SELECT page, count(*) AS n_lines, count(*) FILTER (b.key IS NOT NULL) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (b.key IS NULL), '') AS text
  FROM bare LEFT JOIN bad b ON bare.host = b.host AND bare.key = b.key
  GROUP BY page
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
       length(cut.text) AS n_chars, sha256(cut.text) AS text_sha256
FROM pages LEFT JOIN cut ON pages.page = cut.page
"""
