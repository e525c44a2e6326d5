"""Shared pieces of the operators: reading tables, shared-folder checkpoints, Arrow output."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import cut, running, shared_dir

__all__ = ["batch", "counted", "cut", "ddl", "keyed", "running", "shared_dir", "table", "utf8_binary"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keyed(df: DataFrame, *names: str) -> DataFrame:
    """Just the named columns, a missing one as null; columns beyond them can't clash with an operator's own."""
    return df.select(*[F.col(f"`{n}`") if n in df.columns else F.lit(None).alias(n) for n in names])


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def utf8_binary(column: str = "text"):
    """A text column as bytes, so that Arrow carries the bytes as they are."""
    return F.col(column).cast("binary").alias(column)


def ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.bool_(): "boolean", pa.float64(): "double", pa.binary(): "binary"}
    return ", ".join(f"{f.name} " + (f"array<{kinds[f.type.value_type]}>" if pa.types.is_list(f.type) else kinds[f.type]) for f in schema)


FEW = 1_000_000  # rows of ids up to this counted number are broadcast (some 32 MB); more are joined by a shuffle


def counted(ids: DataFrame, most: int = FEW) -> DataFrame:
    """ids, materialised, and marked for broadcast only if a count shows that they are few."""
    ids = cut(ids)
    return F.broadcast(ids) if ids.count() <= most else ids
