"""Wide matrix files and delimited text with rejects (E-10, S-02, S-04, D-11, D-18)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, shared_path
from ..sources.delimited import read_checked
from ..sources.tables import read_table
from ..sources.wide import read_wide_matrix, write_wide_matrix


def _supplier_days(spark, sf_dir) -> DataFrame:
    """(row, column, value): lines of a supplier on a shipping day."""
    li = read_table(spark, sf_dir, "lineitem", ["l_suppkey", "l_shipdate"])
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    return (li.where(F.col("l_suppkey").isNotNull() & F.col("l_shipdate").isNotNull())
            .groupBy(F.col("l_suppkey").alias("row"), day.alias("column")).agg(F.count("*").alias("value")))


def _wide_file(spark, sf_dir) -> str:
    """Supplier x shipping day as wide text: a column for each of the calendar's days (about 2,500)."""
    cells = cut_lineage(_supplier_days(spark, sf_dir), "supplier-days")
    days = [r[0] for r in cells.select("column").distinct().orderBy("column").collect()]  # days of the calendar
    return write_wide_matrix(cells, days, shared_path(spark, "wide-matrix"), corner="supplier")


def q_wide_matrix_long(spark, sf_dir):
    """A wide file of thousands of columns, read by position into (supplier, day, n)."""
    cells, _ = read_wide_matrix(spark, _wide_file(spark, sf_dir))
    return cells.select(F.col("row").cast("long").alias("supplier"), F.col("column").alias("day"),
                        F.col("value").cast("long").alias("n"))


S_WIDE_MATRIX_LONG = """
SELECT l_suppkey AS supplier, strftime(l_shipdate, '%Y-%m-%d') AS day, count(*) AS n
FROM lineitem WHERE l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL GROUP BY 1, 2"""


def _damaged_lines(spark, sf_dir) -> str:
    """Events as text of four fields, some lines short, long, or with a letter in a number."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "value"])
    sound = F.concat_ws(";", "event_id", "user_id", "event_type", F.format_string("%.4f", "value"))
    kind = F.col("event_id") % 10
    line = (F.when(kind == 1, F.concat_ws(";", "event_id", "user_id", "event_type"))
            .when(kind == 4, F.concat(sound, F.lit(";9")))
            .when(kind == 7, F.concat_ws(";", "event_id", F.concat(F.lit("u"), F.col("user_id")), "event_type",
                                         F.format_string("%.4f", "value"))).otherwise(sound))
    path = shared_path(spark, "damaged-lines")
    ev.where(F.col("event_id").isNotNull()).select(line.alias("value")).write.mode("overwrite").text(path)
    return path


EVENT_LINES = "event_id long, user_id long, event_type string, value double"


def q_csv_kept(spark, sf_dir):
    """Rows of a damaged file that fit the declared schema (S-02)."""
    kept, _ = read_checked(spark, _damaged_lines(spark, sf_dir), EVENT_LINES, sep=";")
    return kept.select("event_id", "user_id", "event_type")


S_CSV_KEPT = """
SELECT event_id, user_id, event_type FROM events WHERE event_id % 10 NOT IN (1, 4, 7)"""


def q_csv_rejects(spark, sf_dir):
    """Its other lines, by the id they begin with, and how many rows were kept (kept + rejected = lines)."""
    kept, rejects = read_checked(spark, _damaged_lines(spark, sf_dir), EVENT_LINES, sep=";")
    n_kept = kept.agg(F.count("*")).scalar()
    return rejects.select(F.split("line", ";")[0].cast("long").alias("event_id"),
                          F.size(F.split("line", ";")).cast("long").alias("fields"), n_kept.alias("n_kept"))


S_CSV_REJECTS = """
SELECT event_id, CAST(CASE event_id % 10 WHEN 1 THEN 3 WHEN 4 THEN 5 ELSE 4 END AS BIGINT) AS fields,
  (SELECT count(*) FROM events WHERE event_id % 10 NOT IN (1, 4, 7)) AS n_kept
FROM events WHERE event_id % 10 IN (1, 4, 7)"""

QUERIES = {
    "wide_matrix_long": q_wide_matrix_long,
    "csv_kept": q_csv_kept,
    "csv_rejects": q_csv_rejects,
}
ORACLES = {
    "wide_matrix_long": S_WIDE_MATRIX_LONG,
    "csv_kept": S_CSV_KEPT,
    "csv_rejects": S_CSV_REJECTS,
}
