"""Cases that went wrong once: roots without a slash, columns named like the operators' own, cuts in long texts."""

import numpy as np
import pytest

from siltstone.llm import language_id
from siltstone.llm.language_id import ngram_buckets
from siltstone.llm.license_scan import scan_licences
from siltstone.llm.line_dedup import drop_recurring_lines

MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction"
)


@pytest.mark.parametrize("front", ["", "/"])
def test_the_roots_licence_reaches_all_files(spark, front):
    rows = [(1, f"{front}LICENSE", MIT, "k"), (2, f"{front}src/main.py", "print", "k"), (3, f"{front}README", "words", "k"), (4, None, "x", "k")]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string, __key string")
    found = {r.doc_id: r for r in scan_licences(files).collect()}
    assert found[1].licence is not None
    assert [found[n].licence for n in (2, 3)] == [found[1].licence] * 2 and found[4].licence is None
    assert found[2].inherited_from == "" and found[2]["__key"] == "k"


def test_line_dedup_keeps_columns_of_any_name(spark):
    line = "this line recurs in every one of the documents"
    rows = [(n, f"{line}\n{"abcdefghijkl"[n] * 3} {"mnopqrstuvwx"[n] * 4}", 1, 2, 3, 4) for n in range(12)] + [(99, None, 1, 2, 3, 4), (98, "", 1, 2, 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __drop int, copy int, row int, `a.b` int")
    found = {r.doc_id: r for r in drop_recurring_lines(docs, 10).collect()}
    assert len(found) == 14 and all(line not in found[n].text and found[n].n_dropped == 1 for n in range(12))
    assert (found[99].text, found[99].n_lines, found[98].text, found[98].n_lines) == (None, 0, "", 1)
    assert all((r["__drop"], r["copy"], r["row"], r["a.b"]) == (1, 2, 3, 4) for r in found.values())


def test_numbers_alone_are_no_template(spark):
    rows = [(n, f"{n} {n + 7}\n{n}\nChapter {n}\nthe quick words of chapter {n} stay the same") for n in range(12)]
    found = drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()
    assert all(r.text.split("\n")[:2] == [f"{r.doc_id} {r.doc_id + 7}", f"{r.doc_id}"] for r in found)
    assert all("quick" not in r.text for r in found)


@pytest.mark.parametrize("size", [5, 7, 50])
def test_cuts_lose_and_add_no_ngrams(monkeypatch, size):
    text = "Abc  déf\nghi " * 9
    (whole,) = ngram_buckets(text, 16)
    monkeypatch.setattr(language_id, "_CHUNK_CHARS", size)
    pieces = list(ngram_buckets(text, 16))
    assert len(pieces) > 1 and np.array_equal(np.sort(np.concatenate(pieces)), np.sort(whole))
