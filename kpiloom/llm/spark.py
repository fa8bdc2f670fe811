"""Spark helpers shared by the text operators: shared scratch tables, checkpoints, components."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.session import checkpoint_root, scratch_path


ARROW_ROWS = 1000
ARROW_BYTES = 8 << 20


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write to a new table in the shared checkpoint folder and read it back: lineage is cut there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``links(a, b)``: (id, comp), comp the smallest id reachable.

    Each round every node takes the first node within two links, in an order drawn anew (partial aggregates,
    so a node with very many links is combined before the shuffle), and the links between what is left are
    kept: a star is settled in one round. Rounds are checkpointed in the shared folder. Raises if
    ``max_rounds`` is not enough; nothing is cut off.
    """
    a, b = F.least("a", "b"), F.greatest("a", "b")
    edges = checkpointed(links.where("a <> b").select(a.alias("a"), b.alias("b")).distinct())
    found = None
    for r in range(max_rounds):
        if edges.isEmpty():
            break
        order = lambda c: F.struct(F.xxhash64(F.lit(r), F.col(c)).alias("h"), F.col(c).alias("v"))  # noqa: B023, E731
        both = edges.union(edges.select("b", "a"))
        first = checkpointed(both.groupBy("a").agg(F.min(order("b")).alias("near"))
                             .select(F.col("a").alias("id"), F.least(order("a"), F.col("near")).alias("m")))
        second = both.join(first, both["b"] == first["id"]).groupBy("a").agg(F.min("m").alias("far"))
        pick = checkpointed(first.join(second, first["id"] == second["a"]).select("id", F.least("m", "far")["v"].alias("to")))
        left, right = pick.toDF("a", "x"), pick.toDF("b", "y")
        edges = checkpointed(edges.join(left, "a").join(right, "b").where("x <> y")
                             .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        if found is None:
            found = pick
        else:
            step = pick.select(F.col("id").alias("mid"), F.col("to").alias("next"))
            found = checkpointed(found.join(step, found["to"] == step["mid"], "left").select("id", F.coalesce("next", "to").alias("to")))
    else:
        raise RuntimeError(f"components: not settled after {max_rounds} rounds")
    if found is None:
        return links.select(F.col("a").alias("id"), F.col("b").alias("comp")).where("false")
    lowest = found.groupBy("to").agg(F.min("id").alias("comp"))
    return checkpointed(found.join(lowest, "to").select("id", "comp"))


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches (texts are long), and this package for the Python workers, as by ``--py-files``."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    sc = spark.sparkContext
    if getattr(sc, "_kpiloom_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="kpiloom-py-")) / "kpiloom.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    sc.addPyFile(str(archive))
    sc._kpiloom_shipped = True
