"""Disk of toxicity: rounds of documents, and shuffles that go when their result is written."""

import os

import pytest
from conftest import *  # noqa: F403

from tidevault.llm import batches, toxicity
from tidevault.llm.components import written
from tidevault.session import work_dir

SF = "/root/testdata/sf0.01"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture
def three(monkeypatch):
    monkeypatch.setattr(batches, "ROUNDS", 3)
    monkeypatch.setattr(batches, "ROUND_BYTES", 1 << 12)


def shuffled(spark):
    """Bytes of each shuffle file there is."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    paths = [p for p in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in p]
    return {p: os.path.getsize(p) for p in paths if os.path.exists(p)}


def test_rounds_hold_every_row_once(docs, odd_docs, odd_rows, three):
    parts = batches.rounds(odd_docs.select("doc_id", "text"))
    assert len(parts) == batches.ROUNDS
    assert multiset(tuple(r) for p in parts for r in p.collect()) == multiset(odd_rows)
    sizes = [p.count() for p in batches.rounds(docs)]
    assert sum(sizes) == docs.count() and max(sizes) < 1.5 * min(sizes)


def test_rounds_give_the_scores_of_the_whole(docs, labels, odd_docs, three, monkeypatch):
    both = docs.select("doc_id", "text").union(odd_docs.select("doc_id", "text"))
    key = lambda r: (str(r[0]), r[1], r[3], r[2])
    parts = sorted(map(tuple, toxicity.toxicity(both, labels).collect()), key=key)
    monkeypatch.setattr(batches, "ROUNDS", 1)
    whole = sorted(map(tuple, toxicity.toxicity(both, labels).collect()), key=key)
    assert [(r[0], r[1], r[3]) for r in whole] == [(r[0], r[1], r[3]) for r in parts]
    assert [r[2] for r in whole] == pytest.approx([r[2] for r in parts], abs=1e-9)


def test_what_a_round_shuffled_is_gone_before_the_next(spark, docs, labels, three, monkeypatch):
    before, left, names = set(shuffled(spark)), [], []

    def noticed(df, name):
        out = written(df, name)
        left.append(sum(n for p, n in shuffled(spark).items() if p not in before))
        names.append(name)
        return out

    monkeypatch.setattr(toxicity, "written", noticed)
    kept = toxicity.decent(docs, labels)
    assert kept.count() > 0 and names.count("toxicity-round") > batches.ROUNDS
    assert max(left) < 20_000  # sums alone, where the text has 2.5 MB


def test_only_the_result_stays_in_the_working_folder(spark, docs, labels, three):
    base = os.path.dirname(work_dir(spark, "x"))
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    assert toxicity.toxicity(docs, labels).count() == docs.count()
    new = set(os.listdir(base)) - before
    assert {n.rsplit("-", 1)[0] for n in new} == {"toxicity-round"} and len(new) == batches.ROUNDS


def test_a_write_leaves_the_setting_as_it_was(spark, docs):
    was = spark.conf.get(CLEANUP)
    written(docs.groupBy("lang").count(), "test-setting")
    assert spark.conf.get(CLEANUP) == was
