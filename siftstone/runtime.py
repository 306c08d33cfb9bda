"""Session helpers: input tables, shared-folder tables that cut lineage, and size-checked broadcasts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

#: A side is broadcast only when it was counted and has at most this many rows and bytes.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir where the cluster names one. One of this session's own where all executors are in this process (tests); else it raises, as each machine would write to its own disk."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + os.path.join(tempfile.gettempdir(), f"siftstone-{os.getpid()}")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def materialize(spark: SparkSession, df: DataFrame, tag: str, compression: str | None = None) -> DataFrame:
    """Write df once into the shared folder and read it back: it cuts lineage and survives lost executors. zstd suits wide tables of texts."""
    path = f"{shared_dir(spark)}/tables/{tag}-{uuid.uuid4().hex}"
    clean = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(clean, None)
    spark.conf.set(clean, "true")  # the table stands for them: its shuffle files go when it is written
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.unset(clean) if before is None else spark.conf.set(clean, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.shared_path = path
    return out


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove materialized tables that no later plan reads."""
    for t in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(t.shared_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def width(kind: DataType, value: Column) -> Column:
    """About how many bytes a value takes in memory."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(kind, ArrayType):
        if isinstance(kind.elementType, (StringType, BinaryType, ArrayType, StructType, MapType)):
            return F.coalesce(F.aggregate(value, F.lit(16).cast("bigint"), lambda s, x: s + width(kind.elementType, x)), F.lit(16))
        return F.coalesce(F.size(value), F.lit(0)) * 8 + 16
    if isinstance(kind, StructType):
        return sum((width(f.dataType, value[f.name]) for f in kind.fields), F.lit(16))
    return F.lit(16) if not isinstance(kind, MapType) else F.coalesce(F.octet_length(value.cast("string")), F.lit(0)) + 16


def sized(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if its counted rows and bytes are within the limits; else Spark shuffles both sides. Columns of varying width are measured."""
    if rows > limit:
        return df
    fixed = [f for f in df.schema.fields if not isinstance(f.dataType, (StringType, BinaryType, ArrayType, StructType, MapType))]
    wide = [f for f in df.schema.fields if f not in fixed]
    total = rows * (24 + 8 * len(fixed))
    if wide and rows:
        total += df.agg(F.sum(sum((width(f.dataType, F.col(f"`{f.name}`")).cast("bigint") for f in wide), F.lit(0))).alias("n")).first()["n"] or 0
    return F.broadcast(df) if total <= most_bytes else df
