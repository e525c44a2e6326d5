"""The folder that a cluster shares, cutting lineage there, and running totals over sorted ranges."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows that dealt() gives to a task; a hash table of them takes some tens of MB.
ROWS_A_TASK = 1 << 18


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names; a folder of one machine wouldn't do on a cluster, so without it this raises."""
    sc = spark.sparkContext
    told = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if told:
        return told.rstrip("/")
    have = sc._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    if sc.master.startswith("local[") or sc.master == "local":  # one machine is the whole cluster
        return f"file://{tempfile.mkdtemp(prefix='checkpoints-')}"
    raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder and cut its lineage."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def dealt(df: DataFrame, rows: int, *keys: str | Column) -> DataFrame:
    """df by keys, in as many tasks as its number of rows needs.

    Left alone, Spark makes a set number of partitions and merges them up to a size in packed
    bytes or down to the number of cores, so that a task's rows grow with the input.
    """
    spark = df.sparkSession
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(max(least, -(-rows // ROWS_A_TASK)), *keys)


def running(df: DataFrame, order: list[str], value: str | None = None, name: str = "pos", parts: int = 0) -> DataFrame:
    """df, materialised, with the total of value (or the number of rows) that comes before each row in a total order.

    Rows are sorted in ranges; the driver sees one total for each range, whose number is a
    setting.  No rows meet in one task beyond their range.
    """
    spark = df.sparkSession
    sorted_ = df.repartitionByRange(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    own = cut(sorted_.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    kind = "bigint" if value is None else dict(df.dtypes)[value]
    kind = "double" if kind in ("double", "float") else "bigint"
    totals = {r[0]: r[1] for r in own.groupBy(part).agg(F.count("*") if value is None else F.sum(F.col(value).cast(kind))).collect()}
    start, before = [F.lit(-1).cast("long"), F.lit(0).cast(kind)], 0
    for k in sorted(totals):
        start += [F.lit(k).cast("long"), F.lit(before).cast(kind)]
        before += totals[k] or 0
    base = F.element_at(F.create_map(*start), part)
    if value is None:
        inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    else:
        w = Window.partitionBy(part).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        inside = F.coalesce(F.sum(F.col(value).cast(kind)).over(w), F.lit(0))
    return own.select(*df.columns, (base + inside).cast(kind).alias(name))
