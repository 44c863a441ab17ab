"""A group of near copies costs about as many verified pairs as it has members."""

import random

import pytest

from riskweave.llm import ngram_join

from .data import documents


def words(rng, n):
    return ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(n)]


@pytest.mark.parametrize("n", [150, 600])
def test_pairs_follow_the_size_of_a_group(spark, monkeypatch, n):
    """Copies link with their original and mostly not with each other."""
    rng = random.Random(1)
    original = words(rng, 124)
    texts = [" ".join(original)]
    for _ in range(n):
        copy = list(original)
        for at in rng.sample(range(124), 2):
            copy[at] = words(rng, 1)[0]
        texts.append(" ".join(copy))
    verified = []
    verify = ngram_join.verify
    monkeypatch.setattr(ngram_join, "verify", lambda pairs, *rest: verified.append(pairs.count()) or verify(pairs, *rest))
    docs = documents(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)])
    found = {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicates(docs).collect()}
    assert set(found.values()) == {0} and len(found) == n + 1
    assert sum(verified) <= 4 * n, verified
