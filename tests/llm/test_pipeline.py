import hashlib

import public_tokenizers
import pytest
import tiktoken
from conftest import *  # noqa: F403

import corpus_pipeline
from tidevault.llm.bpe import ranks_from
from tidevault.llm.components import written
from tidevault.llm.decontaminate import leaks
from tidevault.llm.queries import QUERIES
from tidevault.llm.toxicity import toxicity

SF = "/root/testdata/sf0.001"


def test_every_operator_is_named():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert [s for s, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_join", "suffix_dedup", "decontamination", "byte_bpe"
    ]


@pytest.mark.parametrize("kind", ["real", "odd", "none"])
def test_stages(spark, real_docs, odd_docs, no_docs, kind):
    docs = {"real": real_docs, "odd": odd_docs, "none": no_docs}[kind]
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(written(stage(spark, kept[-1], SF), name))
        if name != "byte_bpe":
            assert kept[-1].schema == docs.schema
    ids = [sorted(map(repr, (r.doc_id for r in k.select("doc_id").collect()))) for k in kept]
    assert all(set(b) <= set(a) for a, b in zip(ids, ids[1:], strict=False))
    labels, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    toxic = {r.doc_id for r in toxicity(docs, labels).collect() if r.predicted}
    assert {repr(i) for i in toxic} == set(ids[0]) - set(ids[1])
    assert len(ids[2]) == len(ids[3])
    leaked = {repr(r.doc_id) for r in leaks(kept[3], items).collect()}
    assert leaked == set(ids[3]) - set(ids[4])
    library = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks_from(public_tokenizers.path("byte_bpe_50k.tiktoken")),
        special_tokens={},
    )
    texts = sorted((repr(r.doc_id), r.text or "") for r in kept[4].collect())
    out = sorted((repr(r.doc_id), list(r.ids), r.decoded_sha256) for r in kept[5].collect())
    want = [(i, library.encode_ordinary(t), hashlib.sha256(t.encode()).hexdigest()) for i, t in texts]
    assert out == sorted(want)
    if kind == "odd":
        assert "1" in ids[5] and "2" in ids[5]  # null and empty texts are clean


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert rows.count() > 0
