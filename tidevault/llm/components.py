"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

import threading
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidevault.session import shuffles_removed, work_dir
from tidevault.sources.folders import Folder

_noted = threading.local()


@contextmanager
def noting() -> Iterator[list[str]]:
    """The paths of the tables that are written meanwhile by this thread."""
    before = getattr(_noted, "paths", None)
    _noted.paths = []
    try:
        yield _noted.paths
    finally:
        _noted.paths = before


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove written tables that nothing reads any more."""
    for path in paths:
        Folder(spark, path).delete("")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again, which cuts the lineage and frees the shuffles' disk."""
    path = work_dir(df.sparkSession, name)
    if getattr(_noted, "paths", None) is not None:
        _noted.paths.append(path)
    with shuffles_removed(df):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stars(edges: DataFrame) -> DataFrame:
    """One round: links of each node to the least node near it; ``a`` > ``b``."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    large = (
        both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    ).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (the least id reachable) of all ids in the links ``a, b``."""
    edges = links.where("a <> b").select(
        F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")
    )
    edges = written(edges.distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        edges = written(_stars(edges), "links")
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
