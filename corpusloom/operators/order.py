"""Running sums and row numbers over a whole table, without a single task for all rows."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Whether the files that a query has shuffled go when it ends.
_SWEPT = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only a session in one process (as in tests) may do without: it gets a
    temporary folder.  On a cluster others could not read that: an error.
    """
    set_ = spark.conf.get("spark.checkpoint.dir", None)
    if set_:
        return set_
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("spark.checkpoint.dir is not set: driver and executors need a shared folder")
    return tempfile.mkdtemp(prefix="shared-")


def cut_lineage(df: DataFrame) -> DataFrame:
    """checkpoint() into the shared folder.

    What the query has shuffled is removed at once: nothing reads it again, and
    else it stays on the disks until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(spark))
    before = spark.conf.get(_SWEPT, None)
    spark.conf.set(_SWEPT, "true")
    try:
        return df.select("*").checkpoint()  # a plan of its own, which no other query shares
    finally:
        spark.conf.unset(_SWEPT) if before is None else spark.conf.set(_SWEPT, before)


def spread(df: DataFrame) -> DataFrame:
    """The same rows over all cores, if a table has fewer splits than there are cores, as one row group can't be split.

    Tables of many splits stay as they are: no shuffle at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def removed(spark: SparkSession, folder: str) -> None:
    """Removes a folder of intermediate results, wherever Spark can write."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def running_sum(df: DataFrame, order: list[str], value: Column, name: str) -> DataFrame:
    """Adds the sum of ``value`` over all rows up to each one, in the order of the columns, which must tell all rows apart.

    Rows are dealt out by ranges of the order; a range's own sums are shifted by
    the sums of the ranges before it, of which there are as many as partitions.
    """
    dealt = df.withColumn("__value", value).repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    dealt = cut_lineage(dealt)
    totals = dealt.groupBy("__range").agg(F.sum("__value").alias("__sum"))
    before = totals.select("__range", F.coalesce(F.sum("__sum").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    own = F.sum("__value").over(W.partitionBy("__range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    # One row for each partition: a broadcast of bounded size.
    return dealt.withColumn("__own", own).join(F.broadcast(before), "__range").withColumn(name, F.col("__own") + F.col("__before")).drop("__own", "__before", "__range", "__value")


def numbered(df: DataFrame, order: list[str], name: str = "n") -> DataFrame:
    """Adds the rows' numbers from 1 in the order of the columns, which must tell all rows apart."""
    return running_sum(df, order, F.lit(1).cast("long"), name)
