"""Wide matrix files: ids of all columns in the first row, a row id and a value a column after it (S-04, E-10).

Such a file has a column for every paper (thousands and more), which no table
schema should have: the lines are read as text, the first row becomes a lookup
table (file, position, column), and every other line is exploded by position.
Each part file of a folder has a first row of its own, so files with different
columns can be read together.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Lines that a writing task builds at once.
LINES = 128


def _pattern(sep: str) -> str:
    return "".join(ch if ch.isalnum() else f"\\{ch}" for ch in sep)


def header_table(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """(file, position, column, line) of every file's first row; positions from 1, the corner left out.

    Only the first block of a file is looked at, and its first line by the order
    of reading (an aggregate; nothing is sorted).  One row for each column.
    """
    first = (spark.read.text(path)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
                     F.monotonically_increasing_id().alias("order"))
             .where(F.col("at") == 0).groupBy("file").agg(F.min_by("value", "order").alias("line")))
    return (first.select("file", "line", F.posexplode(F.split("line", _pattern(sep), -1)).alias("position", "column"))
            .where(F.col("position") > 0))


def read_wide_matrix(spark: SparkSession, path: str, sep: str = "\t") -> tuple[DataFrame, DataFrame]:
    """A wide file (or folder of them) as (row, column, value), and its rejects as (file, line, reason).

    Zero and empty cells are left out.  A line is rejected as a whole, never in
    part, if it has another number of fields than the first row (``width``) or a
    cell that is neither empty nor a number (``cell``); blank lines are skipped.
    Kept lines plus rejects are all lines but the first rows and the blank ones.
    """
    heads = header_table(spark, path, sep)
    widths = heads.groupBy("file", "line").agg(F.max("position").alias("width"))
    # one row for each file; files without a column besides the corner have none
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    lines = (lines.where(F.trim("value") != "").join(widths, "file").where(F.col("value") != F.col("line"))
             .select("file", "value", "width", F.split("value", _pattern(sep), -1).alias("fields")))
    cells = F.slice("fields", F.lit(2), F.greatest(F.size("fields") - 1, F.lit(0)))
    number = F.forall(cells, lambda x: (F.trim(x) == "") | x.try_cast("double").isNotNull())
    reason = F.when(F.size("fields") != F.col("width") + 1, "width").when(~number, "cell")
    marked = lines.withColumn("reason", reason)
    rejects = marked.where(F.col("reason").isNotNull()).select("file", F.col("value").alias("line"), "reason")
    found = (marked.where(F.col("reason").isNull())
             .select("file", F.col("fields")[0].alias("row"), F.posexplode("fields").alias("position", "cell"))
             .withColumn("value", F.col("cell").try_cast("double"))
             .where((F.col("position") > 0) & (F.col("value") != 0)))
    return found.join(heads.drop("line"), ["file", "position"]).select("row", "column", "value"), rejects


def write_wide_matrix(cells: DataFrame, columns: list[str], path: str, sep: str = "\t",
                      corner: str = "id", tasks: int = 4) -> str:
    """Write ``cells(row, column, value)`` as wide text, one part file a task, each with its first row.

    ``columns`` are the ids of all columns, in order.  A line is as long as
    they are many, so the format itself is only for a bounded number of columns.
    """
    place = {c: i for i, c in enumerate(columns)}
    entries = (cells.select(F.col("row").cast("string").alias("row"), F.col("column").cast("string").alias("column"),
                            F.col("value").cast("double").alias("value"))
               .groupBy("row").agg(F.collect_list(F.struct("column", "value")).alias("entries")))  # at most a line

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([sep.join([corner, *columns])])], ["value"])
        for batch in (b.slice(at, LINES) for b in batches for at in range(0, b.num_rows, LINES)):
            out = []
            for row, found in zip(batch.column("row").to_pylist(), batch.column("entries").to_pylist()):
                line = ["0"] * len(columns)
                for e in found:
                    line[place[e["column"]]] = format(e["value"], ".17g")
                out.append(sep.join([row, *line]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    entries.repartition(tasks, "row").mapInArrow(lines, "value string").write.mode("overwrite").text(path)
    return path
