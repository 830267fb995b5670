"""CSV and JSON files. Each writes a folder of part files, one per task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text survives as it is: quotes doubled, outer spaces and line breaks kept.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}

ISO_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


# Rows of one CSV file: as values may hold line breaks, a file is read by one task.
CSV_ROWS = 100_000


def write_csv(df: DataFrame, path: str, rows_per_file: int = CSV_ROWS) -> None:
    """CSV with a header; array columns as JSON text; files of bounded length."""
    columns = [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in df.schema
    ]
    writer = df.select(columns).write.option("maxRecordsPerFile", rows_per_file)
    writer.options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The files of ``write_csv`` with the types of the original frame."""
    arrays = {f.name: f.dataType for f in schema if isinstance(f.dataType, T.ArrayType)}
    flat = T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name in arrays else f for f in schema]
    )
    # A line break may stand inside a quoted value, so a file is read as a whole
    # by one task; the writer's bounded part files keep the read parallel.
    # An empty field is a missing value and "" is empty text; the reader takes
    # both for missing unless its mark of a missing value is something else.
    options = CSV_OPTIONS | {"multiLine": "true", "nullValue": "\0"}
    rows = spark.read.schema(flat).options(**options).csv(path)
    return rows.withColumns({name: F.from_json(name, kind) for name, kind in arrays.items()})


def write_json(df: DataFrame, path: str) -> None:
    """JSON Lines in UTF-8: ISO timestamps in UTC, null fields kept.

    One array around all rows would have to be written by a single task.
    """
    df.write.option("ignoreNullFields", "false").option("timestampFormat", ISO_TIMESTAMP).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("timestampFormat", ISO_TIMESTAMP).json(path)
