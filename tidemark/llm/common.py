"""What the operators of this subpackage share: tables, lineage cuts, graphs."""

from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_root

#: A word: a run of anything but space and the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which all executors share."""
    return f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; ``bytes.split`` cuts at exactly the
    characters that :data:`WORD` leaves out."""
    return text.encode("utf-8").split() if text else []


def place_factors(n: int) -> np.ndarray:
    """Independent odd factors that tell a word's places in an n-gram apart."""
    return np.array([xxhash.xxh3_64_intdigest(b"place %d" % i) | 1 for i in range(n)], np.uint64)


def scatter(h: np.ndarray, factor: int) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(factor)
    return h ^ (h >> np.uint64(29))


def n_words(col: str | Column) -> Column:
    """Number of words, 0 for null, in the JVM."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every id in ``edges(u, v)``; the component is its
    smallest id.

    Large-star and small-star rounds: each rehangs neighbours under the smallest
    id next to them, until every component is one star. A round is a partial
    aggregate and a join on the id, written to the shared folder, so memory
    doesn't grow with a component and no lineage builds up. Null ends and loops
    are left out; repeated edges count once.
    """
    spark = edges.sparkSession

    def state(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    now = written(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct(),
        "edges",
    )
    seen = state(now)
    while seen[0]:
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", "m")).distinct()
        )
        now = written(small, "small-star")
        last, seen = seen, state(now)
        if last == seen:
            break
    out = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return out.union(roots) if seen[0] else spark.createDataFrame([], out.schema)
