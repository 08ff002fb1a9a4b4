"""Batches that stay the same while the cluster changes, and columns of any name."""

import pytest
from conftest import *  # noqa: F403

from tidevault.llm import batches as b
from tidevault.llm.ngram_join import ngram_components, representatives
from tidevault.llm.substring_dedup import without_repeated_windows
from tidevault.llm.suffix_dedup import repeat_report, without_repeats
from tidevault.llm.toxicity import decent, toxicity

CORES = "spark.sql.leafNodeDefaultParallelism"
DIR = "/root/testdata/sf0.01"


def files(spark, n):
    """The documents, whose partitions follow the cores at hand when a scan starts."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set(CORES, n)
    return spark.read.parquet(f"{DIR}/documents.parquet")


def labels(spark):
    return spark.read.parquet(f"{DIR}/labels.parquet")


@pytest.mark.parametrize(
    "run",
    [
        lambda d, s: repeat_report(d, 400),
        lambda d, s: without_repeats(d, 400).select("doc_id", "text"),
        lambda d, s: without_repeated_windows(d, 13),
        lambda d, s: ngram_components(d, 4, 85),
        lambda d, s: toxicity(d, labels(s)),
    ],
    ids=["op5", "pipeline5", "op7", "op3", "op10"],
)
def test_cores_that_come_and_go_change_no_row(spark, monkeypatch, run):
    kept = {c: spark.conf.get(c, None) for c in (CORES, "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        want = multiset(map(tuple, run(files(spark, 3), spark).collect()))  # noqa: F405
        for before, after in ((2, 12), (12, 2)):
            docs = files(spark, before)
            real = b.written

            def switch(df, name, real=real, after=after):
                out = real(df, name)
                spark.conf.set(CORES, after)
                return out

            monkeypatch.setattr(b, "written", switch)
            result = run(docs, spark)
            spark.conf.set(CORES, after)
            got = multiset(map(tuple, result.collect()))  # noqa: F405
            monkeypatch.setattr(b, "written", real)
            assert got == want
    finally:
        for c, v in kept.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)


NAMES = ["__partition", "__s1", "s1", "s2", "group", "component_id", "doc", "place", "batch", "docs", "part", "n"]


def test_columns_of_any_name_pass_through(spark, odd_rows):
    rows = [(*r, *range(len(NAMES))) for r in odd_rows if len(r[1] or "") < 5000]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in NAMES))
    label = spark.createDataFrame([(10, 0), (20, 1), (21, 0), (22, 1), (40, 0)], "doc_id long, toxic int")
    for out in (representatives(docs, 5, 80), without_repeats(docs, 400), decent(docs, label)):
        assert out.columns == docs.columns
        assert all(tuple(r)[2:] == tuple(range(len(NAMES))) for r in out.collect())
    assert representatives(docs, 5, 80).count() > 10


def test_short_strings_are_refused(odd_docs):
    for run in (repeat_report, without_repeats):
        with pytest.raises(ValueError, match="32"):
            run(odd_docs, 31)
