"""The operators of this subpackage as named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidevault.llm.bpe import round_trip
from tidevault.llm.decontaminate import leaks
from tidevault.llm.embeddings import near_vectors
from tidevault.llm.lexical_search import search
from tidevault.llm.ngram_join import ngram_components
from tidevault.llm.packing import packed
from tidevault.llm.quality import quality
from tidevault.llm.sharding import place
from tidevault.llm.substring_dedup import without_repeated_windows
from tidevault.llm.suffix_dedup import repeat_report
from tidevault.llm.token_alignment import alignment
from tidevault.llm.token_counts import token_counts
from tidevault.llm.toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, as in tests."""
    root = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def query(f):
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 7 by a weighted hash tree, and the shard with one more."""
    return place(_table(spark, sf_dir, "documents"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes: 4-word shingles, Jaccard similarity of 0.85 or more."""
    return ngram_components(_table(spark, sf_dir, "documents"), k=4, percent=85)


ORACLES["op3_ngram_join"] = r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    sets AS (
        SELECT doc_id, CASE
            WHEN len(w) = 0 THEN []
            WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
            ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' '))))
            END AS s
        FROM words),
    reps AS MATERIALIZED (SELECT min(doc_id) AS rep, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
    grams AS (SELECT rep, n, unnest(s) AS gram FROM reps),
    links AS MATERIALIZED (
        SELECT a.rep AS x, b.rep AS y
        FROM grams a JOIN grams b ON a.gram = b.gram AND a.rep < b.rep
            AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
        GROUP BY a.rep, b.rep, a.n, b.n
        HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
    ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reached AS (
        SELECT rep AS node, rep AS root FROM reps
        UNION
        SELECT y, root FROM reached JOIN ways ON node = x),
    least_of AS (SELECT node, min(root) AS root FROM reached GROUP BY node)
    SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(root, doc_id)::BIGINT AS component_id
    FROM sets LEFT JOIN reps ON sets.s = reps.s LEFT JOIN least_of ON rep = node"""


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents by byte_bpe_50k.json."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(_table(spark, sf_dir, "documents"), path, 512)


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left without byte strings of 400 that repeat."""
    return repeat_report(_table(spark, sf_dir, "documents"), 400)


ORACLES["op5_suffix_dedup"] = r"""
    WITH hexed AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    sized AS (SELECT doc_id, h, len(h) // 2 AS n FROM hexed),
    starts AS (SELECT doc_id, h, unnest(range(0, n - 399)) AS i FROM sized),
    strings AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS string FROM starts),
    repeated AS (SELECT doc_id, i FROM strings QUALIFY count(*) OVER (PARTITION BY string) > 1),
    marked AS (
        SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 0 ELSE 1 END AS new
        FROM repeated),
    runs AS (
        SELECT doc_id, run, min(i) AS a, max(i) + 400 AS z
        FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked)
        GROUP BY doc_id, run),
    totals AS (SELECT doc_id, sum(z - a) AS removed, count(*) AS spans FROM runs GROUP BY doc_id),
    gaps AS (
        SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS z FROM runs
        UNION ALL
        SELECT doc_id, coalesce(max(z), 0), max(n) FROM sized LEFT JOIN runs USING (doc_id) GROUP BY doc_id),
    kept AS (
        SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (z - a)), '' ORDER BY a) AS h
        FROM gaps JOIN hexed USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed,
        coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
    FROM sized JOIN kept USING (doc_id) LEFT JOIN totals USING (doc_id)"""


@query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all documents' ids by byte_bpe_50k.tiktoken, and of what they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return round_trip(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left without windows of 13 words that an earlier document has."""
    return without_repeated_windows(_table(spark, sf_dir, "documents"), 13)


ORACLES["op7_substring_dedup"] = r"""
    WITH words AS MATERIALIZED (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    windows AS MATERIALIZED (
        SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS run
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words)),
    firsts AS (SELECT run, min(doc_id) AS owner FROM windows GROUP BY run),
    gone AS (
        SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS place
        FROM windows JOIN firsts USING (run) WHERE owner < doc_id),
    places AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM words),
    kept AS (
        SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS t
        FROM places ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
        sha256(coalesce(t, '')) AS kept_sha256
    FROM words LEFT JOIN kept USING (doc_id)"""


@query
def op8_embedding_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of equal label with a cosine of 0.93 or more, and their components."""
    return near_vectors(_table(spark, sf_dir, "embeddings"), 0.93)


ORACLES["op8_embedding_neighbours"] = r"""
    WITH RECURSIVE vectors AS MATERIALIZED (
        SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
        WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS MATERIALIZED (
        SELECT a.vec_id AS x, b.vec_id AS y
        FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
    reached AS (
        SELECT vec_id AS node, vec_id AS root FROM vectors
        UNION
        SELECT y, root FROM reached JOIN links ON node = x),
    least_of AS (SELECT node, min(root) AS root FROM reached GROUP BY node),
    linked AS (SELECT x, count(*) AS n FROM links GROUP BY x)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(root, vec_id)::BIGINT AS component_id,
        coalesce(root, vec_id) = vec_id AS kept
    FROM embeddings LEFT JOIN linked ON vec_id = x LEFT JOIN least_of ON vec_id = node"""


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents contain."""
    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 documents that score most for each benchmark item."""
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 50)


ORACLES["op11_lexical_search"] = r"""
    WITH words AS (
        SELECT doc_id, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents),
    corpus AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS total FROM words WHERE len(terms) > 0),
    tfs AS (
        SELECT doc_id, n, term, count(*) AS tf
        FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM words)
        GROUP BY doc_id, n, term),
    dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
    asked AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark),
    scored AS (
        SELECT item_id, doc_id, sum(
            floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
            * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))))::BIGINT AS score
        FROM asked JOIN dfs USING (term) JOIN tfs USING (term), corpus
        GROUP BY item_id, doc_id)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
          FROM scored WHERE score > 0)
    WHERE rank <= 50"""


@query
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by byte_bpe_50k.json in sequences of 2048 tokens."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packed(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, 2048)


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of byte_bpe_50k.json and piece_bpe_32k.model."""
    paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment(_table(spark, sf_dir, "documents"), *paths, public_tokenizers.PATTERN)
