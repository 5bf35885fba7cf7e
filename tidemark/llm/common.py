"""Helpers that the operators of this subpackage share: written tables, bounded Arrow batches, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch for columns of whole texts, so that a batch of long texts still fits a Python worker.
TEXT_BATCH_ROWS = 512


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for written tables: spark.checkpoint.dir. Only a local master may go without one, as in tests: its
    tasks share this machine's disk. On a cluster an unset folder is an error, as no other executor sees a local one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of written tables that everything built on them has already been written from."""
    for df in tables:
        spark = df.sparkSession
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """df dealt by a hash of key rather than by key, so that a join on key deals both of its sides and can split a hot key."""
    return df.repartition(F.xxhash64(key))


def text_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that carry whole texts to Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH_ROWS))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Label every node of an edge list with the smallest node of its component: columns node, root.

    Alternating large-star and small-star rounds; the minimum of a neighbourhood is a partial aggregate, so a hub is
    pre-aggregated before it is shuffled. Each round is a written table that replaces the last. Nodes without an edge to another node are absent.
    """
    spark = edges.sparkSession
    both = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    now = written(both, "edges")
    before = None
    while True:
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == before or not sign[0]:
            break
        before = sign
        # Large star: every larger neighbour of u is tied to the smallest of u's neighbourhood.
        sides = now.select("u", "v").union(now.select(F.col("v"), F.col("u"))).toDF("x", "y")
        least = sides.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = sides.where("y > x").join(spread(least, "x"), "x").select(F.col("y").alias("u"), F.col("m").alias("v"))
        # Small star: u and its smaller neighbours are tied to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(spread(low, "u"), "u")
        small = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        last, now = now, written(small.where("u <> v").distinct(), "edges")
        discard(last)
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).union(now.select(F.col("v"), F.col("v")).distinct())
