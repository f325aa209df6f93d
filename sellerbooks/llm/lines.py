"""Cross-site line dedup by the spread of a line over distinct sites.

Each line is known by a 128-bit hash of its text without outer blanks. One
aggregation merges a HyperLogLog sketch of the sites (``source``) of each line hash;
task-side partial sketches keep a line that stands on every page from becoming a hot
group. The sketch decides alone where its estimate is clear of the threshold by
``BAND``; lines near the threshold get an exact distinct count. A line on at least
``MIN_SITES`` sites is boilerplate: its first place in the corpus (smallest doc_id,
then row and line) stays, every other one is removed. In a corpus of fewer than twice as
many sites, half of the sites, ``FEW_SITES`` at least, are enough for a line of
``LEAST_CHARS`` characters; shorter ones meet there by chance.

Defined cases: a NULL text has no lines and stays NULL; blank lines are never
removed; a NULL source counts as one site of its own; equal rows are separate
documents; a document may lose all its lines and then keeps an empty text; a very long text
is taken whole, in time that grows with its length; an empty table gives an empty result;
other columns pass through. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerbooks.llm.common import ROW, numbered, numbered_in_files, spread
from sellerbooks.session import materialise

MIN_SITES = 10
FEW_SITES = 3
LEAST_CHARS = 20
SKETCH_BITS = 12
#: Share of the threshold within which the sketch is not trusted; its standard error is 1.6 %.
BAND = 0.15
BLANKS = " \t\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def enough_sites(sites: int) -> int:
    """The sites that make a line of ``LEAST_CHARS`` characters boilerplate in a corpus of ``sites`` sites."""
    return min(MIN_SITES, max(FEW_SITES, -(-sites // 2)))


def line_places(rows: DataFrame, short: int = MIN_SITES, long: int = MIN_SITES) -> DataFrame:
    """(_row, doc_id, site, line, h1, h2, least): every line of the numbered documents that is not blank, by hash.

    ``least``: the sites that make it boilerplate, ``short`` or, from ``LEAST_CHARS`` characters on, ``long``.
    """
    rows = rows.select(ROW, "doc.doc_id", F.col("doc.source").alias("site"), "doc.text")
    rows = rows.select(ROW, "doc_id", "site", F.posexplode(_lines(F.col("text"))).alias("line", "said"))
    rows = rows.withColumn("said", F.btrim("said", F.lit(BLANKS))).filter("said <> ''")
    hashes = F.xxhash64("said").alias("h1"), F.xxhash64(F.lit(1), "said").alias("h2")
    # The leading mark sets a missing source apart from an empty one.
    site = F.coalesce(F.concat(F.lit("s"), F.col("site")), F.lit("")).alias("site")
    least = F.when(F.length("said") >= LEAST_CHARS, long).otherwise(short)
    return rows.select(ROW, "doc_id", site, "line", *hashes, least.alias("least"))


def boilerplate(places: DataFrame) -> DataFrame:
    """(h1, h2, first): lines on at least ``least`` sites, with their first place."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", ROW, "line")
    spread = places.groupBy("h1", "h2").agg(
        F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"), F.min(place).alias("first"), F.max("least").alias("least")
    )
    estimated = materialise(
        spread.select("h1", "h2", "first", "least", F.hll_sketch_estimate("sketch").alias("sites")).filter(
            F.col("sites") >= F.col("least") * (1 - BAND)
        )
    )
    clear = estimated.filter(F.col("sites") > F.col("least") * (1 + BAND))
    near = estimated.filter(F.col("sites") <= F.col("least") * (1 + BAND))
    exact = (
        places.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi")
        .groupBy("h1", "h2", "site")
        .agg(F.max("least").alias("least"))
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("exact"), F.max("least").alias("least"))
        .filter(F.col("exact") >= F.col("least"))
        .select("h1", "h2")
    )
    return clear.select("h1", "h2", "first").unionByName(near.join(exact, ["h1", "h2"]).select("h1", "h2", "first"))


def dedup_lines(docs: DataFrame, min_sites: int | None = None, in_files: bool = False) -> DataFrame:
    """The documents without repeated boilerplate lines; adds (or replaces) n_lines and n_removed.

    ``min_sites`` in place of the threshold that follows the number of sites. ``in_files``:
    the documents are read from Parquet files as they lie there.
    """
    # Numbered for good before the lines are spread: the removals below are keyed by these ids.
    rows = numbered_in_files(docs) if in_files else materialise(numbered(docs))
    if min_sites is None:
        thresholds = MIN_SITES, enough_sites(rows.select("doc.source").distinct().count())
    else:
        thresholds = min_sites, min_sites
    places = materialise(line_places(rows, *thresholds))
    found = boilerplate(places).select("h1", "h2", F.col("first").alias("f"))
    extra = places.join(found, ["h1", "h2"]).filter((F.col(ROW) != F.col(f"f.{ROW}")) | (F.col("line") != F.col("f.line")))
    removed = extra.groupBy(F.col(ROW).alias("_r")).agg(F.collect_list("line").alias("_gone"))
    rows = rows.join(removed, F.col(ROW) == F.col("_r"), "left")
    whole = F.col("doc.text")
    lines = _lines(whole)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    # The text is split once a document: a lambda over an array of one struct names its parts, so a text of many lines costs its length.
    parts = F.array(F.struct(lines.alias("lines"), kept.alias("kept")))
    joined = F.transform(parts, lambda p: F.array_join(F.transform(p["kept"], lambda i: F.get(p["lines"], i)), "\n"))
    text = F.when(F.col("_gone").isNull(), whole).otherwise(F.get(joined, F.lit(0)))
    lines_in = F.when(F.coalesce(F.length(whole), F.lit(0)) == 0, 0).otherwise(F.size(lines))
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return rows.select(
        *spread(rows, own, text),
        lines_in.cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


#: The same rule in check SQL, exact throughout.
CHECK_SQL = f"""
WITH l AS (
  SELECT doc_id, coalesce('s' || source, '') AS site, unnest(string_split(text, chr(10))) AS said,
         unnest(range(len(string_split(text, chr(10))))) AS line
  FROM documents),
t AS (SELECT doc_id, site, line, trim(said, ' ' || chr(9) || chr(13)) AS said FROM l),
s AS (SELECT count(DISTINCT coalesce('s' || source, '')) AS sites FROM documents),
b AS (
  SELECT said, min(doc_id * 1000000000 + line) AS first FROM t, s WHERE said <> ''
  GROUP BY said, sites HAVING count(DISTINCT site) >= {MIN_SITES}
    OR length(said) >= {LEAST_CHARS} AND count(DISTINCT site) >= greatest({FEW_SITES}, (sites + 1) // 2)),
gone AS (SELECT t.doc_id, t.line FROM t JOIN b USING (said) WHERE t.doc_id * 1000000000 + t.line <> b.first),
k AS (
  SELECT l.doc_id, string_agg(l.said, chr(10) ORDER BY l.line) AS kept
  FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.line = gone.line WHERE gone.doc_id IS NULL GROUP BY l.doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT d.doc_id,
  CAST(CASE WHEN coalesce(length(d.text), 0) = 0 THEN 0 ELSE len(string_split(d.text, chr(10))) END AS BIGINT) AS n_lines,
  CAST(coalesce(n.n_removed, 0) AS BIGINT) AS n_removed,
  CAST(length(coalesce(k.kept, '')) AS BIGINT) AS kept_chars,
  md5(coalesce(k.kept, '')) AS kept_md5
FROM documents d LEFT JOIN k USING (doc_id) LEFT JOIN n USING (doc_id)
"""
