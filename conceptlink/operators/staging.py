"""Written intermediate tables, so that lineage is cut and lost executors do not matter."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

_local_roots: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """Folder of this application below the session's ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) gets a temporary folder.
    """
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_roots.setdefault(app, tempfile.mkdtemp(prefix="conceptlink-"))
    return f"{root.rstrip('/')}/conceptlink/{app}"


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` once and return a frame that reads the written copy."""
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows out to all cores when the input has fewer partitions than that.

    For costly work per row on a few unsplittable files; input in many files is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def partition_keys(spark: SparkSession, count: int) -> list[int]:
    """Numbers that ``repartition`` by a number deals to ``count`` partitions, one to each."""
    drawn = spark.range(32 * count).select(F.col("id").cast("int").alias("key"), F.pmod(F.hash(F.col("id").cast("int")), F.lit(count)).alias("at"))
    one = drawn.toPandas()
    first = one.drop_duplicates("at").sort_values("at")["key"].tolist()
    return sorted((first + [k for k in one["key"].tolist() if k not in set(first)])[:count])


def drop_staging(spark: SparkSession) -> None:
    """Delete the tables this application staged; call it when results are stored."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(staging_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
