"""How much sorting the suffixes of a group take."""

import numpy as np

from tidevault.llm import substring_dedup


def test_suffixes_are_sorted_only_as_far_as_they_agree(monkeypatch):
    sorted_ = []

    def counting(name, length):
        real = getattr(np, name)
        monkeypatch.setattr(np, name, lambda x, *a, **k: (sorted_.append(length(x)), real(x, *a, **k))[1])

    counting("argsort", len)
    counting("lexsort", lambda columns: sum(map(len, columns)))
    words = np.random.default_rng(5).integers(0, 1 << 20, 50_000).astype(np.uint32)
    words = np.concatenate((words, words[:2_000]))
    starts = np.arange(len(words) - 13)
    order, node = substring_dedup.deep_nodes(words, starts, 13)
    assert sum(sorted_) < 2 * len(starts)
    assert len(np.unique(node)) == len(starts) - (2_000 - 13)
    found = [tuple(words[i : i + 13].tolist()) for i in starts[order].tolist()]
    assert found == sorted(found)
    assert [a == b for a, b in zip(found, found[1:], strict=False)] == (np.diff(node) == 0).tolist()
