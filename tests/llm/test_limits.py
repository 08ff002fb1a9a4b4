"""Memory of scoring a batch, on which the limit of a whole query hangs."""

import tracemalloc

import numpy as np
import pytest

from tidevault.llm import toxicity


@pytest.fixture
def models(monkeypatch):
    """Models of invented counts, which depend on the key alone."""

    def counts(answers, keys, parts, widths):
        shifts = [np.arange(w, dtype=np.uint64)[:, None] * np.uint64(7) for w in widths]
        out = [((k[None, :] >> s) % np.uint64(50)).astype(float) for k, s in zip(keys, shifts, strict=True)]
        out[1][-1] += 1
        return out

    monkeypatch.setattr(toxicity, "fetched", counts)
    of_class = [1e6, 4e5, 1e5, 5e4, 2e4, 3e5]
    return toxicity.Models(np.array([1e5, 2e5, *of_class, *of_class[::-1]]), [16, 16])


def test_a_batch_is_measured_in_little_memory(models):
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(10_000, 99_999, 450).tolist())).encode() for _ in range(1_500)]
    tracemalloc.start()
    models.features(texts, [])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 28 * sum(map(len, texts))


@pytest.mark.parametrize("own", [None, np.arange(41) % 2])
def test_pieces_give_the_features_of_the_whole(models, monkeypatch, own):
    texts = [b" ".join(b"w%d" % (i * j % 17) for j in range(i * 7 % 90)) for i in range(41)]
    whole = models.features(texts, [], own)
    for most in (1, 50, 300):
        pieces = toxicity.Found.pieces
        with monkeypatch.context() as m:
            m.setattr(toxicity.Found, "pieces", lambda f, most=most, pieces=pieces: pieces(f, most))
            assert np.allclose(models.features(texts, [], own), whole, rtol=0, atol=1e-9)
    assert models.features([b""], []).shape == (1, whole.shape[1])
