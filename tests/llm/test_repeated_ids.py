"""Rows that share an id but not the text or the vector."""

import itertools

import numpy as np

from siltstone.llm.embedding_dedup import embedding_components
from siltstone.llm.jaccard_join import jaccard_components, keep_representatives

BASE = [f"w{n}" for n in range(60)]
ONE = "quite another text of words that occur in no other row at all"
TWO = " ".join(BASE)
THREE = " ".join([*BASE[:-1], "other"])
FAR = " ".join(reversed(BASE))


def test_rows_of_one_id_are_one_document(spark):
    rows = [(1, ONE), (2, ONE), (2, TWO), (2, TWO), (3, THREE), (4, FAR), (5, None), (5, FAR), (None, THREE), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(r.doc_id, r.component_id) for r in jaccard_components(docs).collect()]
    assert len(found) == len(rows)
    assert set(found) == {(1, 1), (2, 1), (3, 1), (None, 1), (4, 4), (5, 4), (6, 6)}
    kept = sorted((r.doc_id or 0, r.text) for r in keep_representatives(docs, 4, 85).collect())
    assert kept == [(0, THREE), (1, ONE), (4, FAR), (6, "")]


def test_an_id_with_many_texts_and_many_equal_rows(spark):
    many = [(7, " ".join(f"t{n}x{k}" for k in range(40))) for n in range(50)]
    like = [(100 + n, f"{text} end") for n, (_, text) in enumerate(many)]
    rows = many + like + [(7, many[0][1])] * 200
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows) and {r.component_id for r in found} == {7}


def _near(rng, vector, cosine):
    other = rng.normal(size=len(vector))
    other -= vector * (other @ vector) / (vector @ vector)
    return cosine * vector / np.linalg.norm(vector) + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


def test_vectors_that_share_an_id_link_by_their_cosine(spark):
    rng = np.random.default_rng(3)
    one, two = rng.normal(size=(2, 24))
    vectors = [(1, one), (2, one), (2, two), (3, _near(rng, two, 0.99)), (None, _near(rng, one, 0.97)), (None, -one), (9, -two)]
    rows = [(n, v.tolist(), 1) for n, v in vectors]
    found = embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    links = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in found)
    expected = []
    for a, (n, v) in enumerate(vectors):
        linked = [m for b, (m, w) in enumerate(vectors) if a != b and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.93]
        ids = [m for m in [n, *linked] if m is not None]
        least = min(ids, default=0)
        expected.append((n or 0, len(linked), least, (n or 0) == least))
    assert links == sorted(expected)


def test_links_of_one_label_with_many_cells(spark):
    """Pairs just above the threshold, in a label large enough to be split by signs."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(3000, 32))
    pairs = [_near(rng, v, c) for v, c in zip(base[:400], rng.uniform(0.93, 0.935, 400))]
    rows = [(n, v.tolist(), 1) for n, v in enumerate([*base, *pairs])]
    found = embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    component = {r.vec_id: r.component_id for r in found.collect()}
    assert np.mean([component[3000 + n] == component[n] for n in range(400)]) >= 0.985
    norms = {n: np.linalg.norm(v) for n, v, _ in rows[:50]}
    for (a, x, _), (b, y, _) in itertools.combinations(rows[:50], 2):
        if np.dot(x, y) / (norms[a] * norms[b]) < 0.9:
            assert component[a] != component[b]
