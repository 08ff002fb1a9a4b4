"""A corpus pipeline: five operators in a row, each on what the one before has kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet
and read again as the next one's ``docs``. All but the last return the columns of
``documents``. A stage's result has to be written before another stage is called: that one
removes the working tables that it was made of. Rows without doc_id go through the stages like others; a null or empty text is
neither toxic, a copy nor a leak, so it is kept, with no tokens in the end.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidevault.llm.bpe import round_trip
from tidevault.llm.components import noting, remove, written
from tidevault.llm.decontaminate import clean
from tidevault.llm.ngram_join import representatives
from tidevault.llm.queries import ship
from tidevault.llm.suffix_dedup import without_repeats
from tidevault.llm.toxicity import decent


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: The stage called last, and the working tables that its result reads.
_last: list = [None, []]


def stage(f: Stage) -> Stage:
    """A stage that first removes the working tables of the one before, whose result is written."""

    @wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _last[0] not in (None, f.__name__):
            remove(spark, _last[1])
            _last[1] = []
        with noting() as paths:
            out = f(spark, docs, sf_dir)
        _last[0], _last[1] = f.__name__, [*_last[1], *paths]
        return out

    return run


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    ship(spark)
    return decent(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (5-word shingles, 0.8) the least doc_id stays."""
    ship(spark)
    return representatives(docs, k=5, percent=80)


@stage
def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes that repeat are taken out of the texts."""
    ship(spark)
    return without_repeats(docs, 400)


@stage
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    ship(spark)
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of what is left, with digests of ids and of the decoded bytes."""
    ship(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return round_trip(docs, path, public_tokenizers.PATTERN, with_ids=True, kept=50_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_duplicates),
    ("suffix_dedup", drop_repeats),
    ("decontamination", drop_leaks),
    ("byte_bpe", encode),
]

#: SQL cannot express the models, the classes of near-duplicates or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    out = STAGES[-1][1](spark, docs, sf_dir)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", F.col("ids"))
