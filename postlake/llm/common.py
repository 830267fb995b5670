"""What several operators share: word splitting, stored steps, training splits."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import postlake.llm
from postlake.session import scratch_path

# Functions of these modules travel to the workers by value, so the workers need not
# have this package installed. Broadcasts hold plain data for the same reason.
cloudpickle.register_pickle_by_value(postlake.llm)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
# A-Z in lower case; every other ASCII character but letters and digits a space.
FOLD_WORDS = bytes(
    ord(chr(i).lower()) if i < 128 and chr(i).isalnum() else i if i >= 128 else 32
    for i in range(256)
)
BATCH_BYTES = 2 << 20


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a step to the shared scratch folder and read it back.

    This cuts the lineage, and what a lost executor had is read again from
    there instead of being computed anew.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Limit Arrow batches by bytes, so that long texts can't fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_batches(
    df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    bounded_batches(df.sparkSession)
    return df.mapInArrow(step, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def batch(schema: str, *columns) -> pa.RecordBatch:
    """A batch from columns in the order of a simple ``name type, ...`` schema."""
    fields = [part.strip().split(" ", 1) for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [
            x if isinstance(x, pa.Array) else pa.array(x, TYPES[kind])
            for x, (_, kind) in zip(columns, fields, strict=True)
        ],
        [name for name, _ in fields],
    )


TYPES = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "binary": pa.binary(),
    "boolean": pa.bool_(),
    "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<double>": pa.list_(pa.float64()),
    "array<string>": pa.list_(pa.string()),
}


def split_of(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % modulus


def texts(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, with ``text`` as a string."""
    return docs.select(
        *(F.col(c).cast("string").alias(c) if c == "text" else F.col(c) for c in columns)
    )
