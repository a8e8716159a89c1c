"""Line dedup by distinct-site spread.

A line that many sites carry is boilerplate.  Per line hash a HyperLogLog
sketch of its sites is built in map-side partial aggregates and merged, so a
line that stands in a third of all documents is one small row per task.
Lines whose estimate lies near the threshold get an exact distinct count of
their sites; lines clearly above need none.  All occurrences of a boilerplate
line go but the first one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faresight.llm.common import SPACES, materialize

#: Distinct sites from which on a line is boilerplate.
MIN_SITES = 10
#: log2 of the sketch's registers; relative error 1.04 / sqrt(2 ** SKETCH_LOG_K).
SKETCH_LOG_K = 12
#: Estimates within this share of the threshold are counted exactly; six standard errors.
NEAR = 6 * 1.04 / 2 ** (SKETCH_LOG_K / 2)

_LINE = ["_h1", "_h2"]


def _with_keys(docs: DataFrame, id_col: str, site_col: str, text_col: str) -> DataFrame:
    """The whole row as ``_row``, so that no column of the input can clash, and the columns used here."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
                       F.coalesce(F.concat(F.lit("="), F.col(site_col).cast("string")), F.lit("")).alias("_site"),
                       F.col(id_col).isNull().alias("_no_id"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("_id")
                       ).withColumn("_version", F.xxhash64("_text"))


def boilerplate_positions(docs: DataFrame, id_col: str = "doc_id", site_col: str = "source",
                          text_col: str = "text", min_sites: int = MIN_SITES) -> DataFrame:
    """``_no_id, _id, _version, removed``: positions of the lines to remove, per row with any.

    ``removed`` holds at most the positions of the row's own lines.
    """
    line = F.trim(F.col("_line"), F.lit(SPACES))
    lines = materialize(
        _with_keys(docs, id_col, site_col, text_col)
        .select("_no_id", "_id", "_version", "_site", F.posexplode(F.split("_text", "\n")).alias("_pos", "_line"))
        .filter(line != "")
        .select("_no_id", "_id", "_version", "_site", "_pos",
                F.xxhash64(line).alias("_h1"), F.hash(line).alias("_h2")), "lines")
    spread = (lines.groupBy(*_LINE).agg(F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(SKETCH_LOG_K))).alias("_sites"))
              .filter(F.col("_sites") >= min_sites * (1 - NEAR))
              .withColumn("_near", F.col("_sites") < min_sites * (1 + NEAR)))
    # aggregated sides are written before they are joined: with a plain exchange on both sides a hot line can be split
    found = materialize(lines.join(materialize(spread.drop("_sites"), "line-spread"), _LINE), "line-candidates")
    exact = (found.filter("_near").groupBy(*_LINE).agg(F.count_distinct("_site").alias("_sites"))
             .filter(F.col("_sites") >= min_sites).select(*_LINE))
    sure = found.filter("NOT _near").select(*_LINE).distinct()
    place = F.struct("_no_id", "_id", "_version", "_pos")
    first = found.groupBy(*_LINE).agg(F.min(place).alias("_first")).join(exact.unionByName(sure), _LINE)
    return (found.join(materialize(first, "line-firsts"), _LINE).filter(place != F.col("_first"))
            .groupBy("_no_id", "_id", "_version").agg(F.collect_set("_pos").alias("removed")))


def remove_boilerplate(docs: DataFrame, id_col: str = "doc_id", site_col: str = "source",
                       text_col: str = "text", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with boilerplate lines removed from ``text_col``, plus ``n_lines`` and ``n_removed``.

    Lines are split at ``\\n`` and compared without the white space around them;
    blank lines are never boilerplate.  A line found on ``min_sites`` distinct
    sites is removed everywhere but at its first place (smallest id, null
    last; then text hash, then position).  A null site is a site of its own.

    Null text: one empty line, null stays null.  Rows equal in id and text
    are treated alike (if one holds the first place, each keeps it).  Empty
    tables give empty results.  Other columns are carried along; columns
    named ``n_lines`` or ``n_removed`` in the input are replaced.
    """
    keys = ["_no_id", "_id", "_version"]
    carried = docs.drop("n_lines", "n_removed")
    removed = boilerplate_positions(carried, id_col, site_col, text_col, min_sites)
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "removed")
    text = F.when(F.col("removed").isNull(), F.col("_row").getField(text_col)).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n"))
    return (_with_keys(carried, id_col, site_col, text_col).join(removed, keys, "left")
            .withColumn("_lines", F.split("_text", "\n"))
            .select(*[(text if c == text_col else F.col("_row").getField(c)).alias(c) for c in carried.columns],
                    F.size("_lines").cast("long").alias("n_lines"),
                    F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed")))


#: DuckDB SQL for the rows of the registered query: exact distinct counts.
ORACLE_SQL = f"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
t AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM l),
b AS (
  SELECT bare FROM t WHERE bare <> '' GROUP BY bare
  HAVING count(DISTINCT coalesce('=' || source, '')) >= {MIN_SITES}),
r AS (
  SELECT t.*, b.bare IS NOT NULL AND row_number() OVER (PARTITION BY t.bare ORDER BY doc_id, pos) > 1 AS gone
  FROM t LEFT JOIN b ON t.bare = b.bare)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
FROM r GROUP BY doc_id
"""
