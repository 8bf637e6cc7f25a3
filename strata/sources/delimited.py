"""Delimited text sources and sinks (S-02 .. S-04, S-06).

The reference reads delimited text through RDD lambdas (``split`` then
``int()``/``float()`` per row) or with ``inferSchema`` (an extra pass over
the file).  Here the CSV reader does the splitting and typing in the JVM
against a declared schema; inference is offered but not the default.
Malformed rows become nulls (``PERMISSIVE``) or are dropped
(``DROPMALFORMED``) instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Lossless text form of timestamps (microseconds kept; the CSV default keeps ms).
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_delimited(spark: SparkSession, path: str, schema: StructType | str | None = None,
                   sep: str = ",", header: bool = False, mode: str = "PERMISSIVE",
                   infer: bool = False) -> DataFrame:
    """Scan delimited text; positional ``_c0..`` names when no header/schema."""
    reader = (spark.read.option("sep", sep).option("header", str(header).lower())
              .option("mode", mode).option("timestampNTZFormat", TIMESTAMP_TEXT)
              .option("timestampFormat", TIMESTAMP_TEXT))
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_checked(spark: SparkSession, path: str, schema: StructType | str,
                 sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Rows that fit ``schema``, and the lines that don't as (file, line) (S-02, D-18).

    A line with a missing or further field, or a field that can't be read as its type,
    goes to the rejects as a whole instead of becoming a row with nulls that look
    like data.  Kept rows plus rejects are all lines that aren't blank.  The file is
    headerless with one record a line; it is read as text, so that every field
    is parsed even where a query needs only some of them.
    """
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    bad = "_rejected_line"
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad,
               "timestampNTZFormat": TIMESTAMP_TEXT, "timestampFormat": TIMESTAMP_TEXT}
    whole = StructType([*fields.fields, StructField(bad, StringType())])
    lines = (spark.read.text(path).where(F.trim("value") != "")
             .select("value", F.col("_metadata.file_path").alias("file"),
                     F.from_csv("value", whole.toDDL(), options).alias("row")))
    kept = lines.where(F.col(f"row.{bad}").isNull()).select(*[F.col("row")[f.name].alias(f.name) for f in fields.fields])
    return kept, lines.where(F.col(f"row.{bad}").isNotNull()).select("file", F.col("value").alias("line"))


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = False) -> str:
    """Write ``df`` as delimited text (overwrite); returns ``path``."""
    (df.write.mode("overwrite").option("sep", sep).option("header", str(header).lower())
       .option("timestampNTZFormat", TIMESTAMP_TEXT).option("timestampFormat", TIMESTAMP_TEXT)
       .csv(path))
    return path


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """Give positional ``_cN`` columns real names (``toDF(names)``, S-06)."""
    return df.toDF(*names)
