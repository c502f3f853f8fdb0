"""Long inverted lists: compared by chunks, with the links of brute force."""

import numpy as np
import pytest

from siltstone.llm import jaccard_join
from siltstone.llm.jaccard_join import jaccard_components, similar_in_block, spanning_star

LETTERS = [f"w{n}" for n in range(400)]


def _group(rng, base, copies, changes):
    """Copies of ``base`` with so many words replaced each: pairs of them lie about the threshold."""
    for _ in range(copies):
        words = list(base)
        for at in rng.choice(len(words), changes, replace=False):
            words[at] = f"x{rng.integers(1 << 40)}"
        yield " ".join(words)


def _expected(texts, words, percent):
    sets = [{tuple(t.split()[i : i + words]) for i in range(max(1, len(t.split()) - words + 1))} if t.split() else set() for t in texts]
    label = list(range(len(texts)))

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                low, high = sorted((root(a), root(b)))
                label[high] = low
    return {n: (len(sets[n]), root(n)) for n in range(len(texts))}


@pytest.mark.parametrize("chunk, dealings", [(512, 4), (16, 1)])
def test_groups_about_the_threshold(spark, monkeypatch, chunk, dealings):
    monkeypatch.setattr(jaccard_join, "CHUNK_SETS", chunk)
    monkeypatch.setattr(jaccard_join, "DEALINGS", dealings)
    monkeypatch.setattr(jaccard_join, "LARGE_COMPONENT", 8)
    rng = np.random.default_rng(5)
    texts = []
    for changes in (1, 2, 3, 4):  # from all linked to none
        base = rng.choice(LETTERS, 90 + 5 * changes)
        texts += _group(rng, base, 60, changes)
    passage = " ".join(rng.choice(LETTERS, 12))
    texts += [f"{passage} " + " ".join(rng.choice(LETTERS, 3)) for _ in range(50)] + ["", "one", "one two"]
    order = rng.permutation(len(texts))
    texts = [texts[n] for n in order]
    found = jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == _expected(texts, 4, 85)


def test_blocks_find_exactly_the_similar_pairs(monkeypatch):
    monkeypatch.setattr(jaccard_join, "SLAB", 7)
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 40, rng.integers(1, 40)).astype(np.uint64)) for _ in range(60)]
    left, right = np.arange(0, 25), np.arange(25, 60)
    found = set(zip(*(x.tolist() for x in similar_in_block(sets, left, right, 50))))
    expected = {
        (a, b) for a in left.tolist() for b in right.tolist()
        if 2 * len(np.intersect1d(sets[a], sets[b])) >= len(np.union1d(sets[a], sets[b]))
    }
    assert found == expected and expected


def test_stars_span_connected_parts():
    chain = np.arange(99)
    assert (spanning_star(101, chain + 1, chain)[:100] == 0).all()
    assert spanning_star(101, chain + 1, chain)[100] == 100
    none = np.zeros(0, int)
    assert (spanning_star(3, none, none) == np.arange(3)).all()
