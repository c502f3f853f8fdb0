"""Pairs of terms count alike in texts of any length."""

import itertools

import numpy as np
import pytest

from siltstone.llm.toxicity import FactorizationMachine, score_toxicity, term_buckets

NEUTRAL = [f"n{chr(97 + k // 676)}{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}" for k in range(2000)]


def _text(rng, length, group, verb):
    words = [*rng.choice(NEUTRAL, length), *["groupx"] * group, *["insultx"] * verb]
    return " ".join(rng.permutation(words))


def test_a_pair_learned_in_short_texts_is_found_in_long_ones(spark):
    rng = np.random.default_rng(4)
    kinds = [(1, 1), (1, 1), (1, 0), (0, 1)]
    short = [(n, _text(rng, 20, *kinds[n % 4]), int(n % 4 < 2)) for n in range(3000)]
    # held out by having no label
    long = [(10_000 * m + n, _text(rng, m, *kinds[n % 4]), int(n % 4 < 2)) for m in (200, 1000) for n in range(100)]
    docs = spark.createDataFrame([r[:2] for r in short + long], "doc_id long, text string")
    labels = spark.createDataFrame([(n, y) for n, _, y in short], "doc_id long, toxic int")
    predicted = {r.doc_id: r.predicted for r in score_toxicity(docs, labels).collect()}
    for least, most in ((0, 3000), (2_000_000, 2_000_100), (10_000_000, 10_000_100)):
        rows = [r for r in short + long if least <= r[0] < most]
        assert np.mean([predicted[n] == y for n, _, y in rows]) > 0.95


@pytest.mark.parametrize("words", [0, 1, 12, 150])
def test_margin_equals_the_sum_over_all_pairs(words):
    rng = np.random.default_rng(words)
    size = 1 << 10
    model = FactorizationMachine(0.3, rng.normal(size=size), rng.normal(0, 0.2, (size, 4)), rng.random(size) < 0.4, 10)
    text = " ".join(rng.choice(NEUTRAL, words))
    terms = term_buckets(text, 10).tolist()
    pairs = [(a, b) for a, b in itertools.combinations(terms, 2) if model.interact[a] and model.interact[b]]
    expected = 0.3 + sum(model.weight[t] for t in terms) + sum(model.factors[a] @ model.factors[b] for a, b in pairs)
    assert model.margin(np.array(terms, dtype=np.int64)) == pytest.approx(expected)


def test_odd_rows_have_a_score(spark):
    rows = [(None, None), (1, ""), (1, "groupx insultx"), (2, None), (2, "word"), (3, "groupx " * 20000)]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (4, 7)], "doc_id long, toxic int")
    found = score_toxicity(docs, labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
