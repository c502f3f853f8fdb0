"""Licences of files: TF-IDF cosine to templates, then inheritance from the nearest ancestor directory."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import attach_groups
from siltstone.sinks.staging import stage

# How licences are usually stated at the head of a file or in a licence file. Fixed values.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at",
    ],
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
        "Licensed under the GNU Affero General Public License, version 3.",
    ],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License."],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met",
        "Licensed under the BSD 3-Clause License.",
    ],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0-1.0": ["This work is dedicated to the public domain under CC0 1.0 Universal."],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public"
        " License 2.0",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation; either version 2 of the License",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
        "Released under the ISC License.",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation; either version 2.1 of the License",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
    ],
    "LGPL-3.0": [
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation, either version 3 of the License",
        "Licensed under the GNU Lesser General Public License, version 3.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files, to deal in the Software without restriction",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "all-rights-reserved": ["All rights reserved."],
}

_TERM = re.compile(r"[^\W_]+")
_LICENCE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice|copyright)([.\-_][^/]*)?$"
LEAST_COSINE = 0.6
WORDS = ["statement_words", "text_words"]
ADDED = ["own_licence", "cosine", "licence_file", "licence", "inherited_from"]
# Document frequencies are kept by hash of the term: a fixed size, whatever the corpus.
TERM_BITS = 20


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


def term_bucket(term: str) -> int:
    return xxhash.xxh3_64_intdigest(term) >> (64 - TERM_BITS)


@dataclass(frozen=True)
class Form:
    """One template: its licence, its number of terms, the unit vector of its TF-IDF weights, and its anchors.

    Any text whose cosine to the form is the least one or more shares terms with it whose squared
    weights add up to that cosine's square. The anchors are the heaviest terms, as many as leave less
    than that to the others: such a text holds one of them, however common they are.
    """

    name: str
    length: int
    vector: dict[str, float]
    anchors: frozenset[str]


@dataclass(frozen=True)
class LicenceModel:
    """The templates' forms, and document frequencies of all terms by bucket."""

    forms: list[Form]
    documents: int
    frequency: np.ndarray
    least: float

    @staticmethod
    def of(
        templates: dict[str, list[str]], documents: int, frequency: np.ndarray, least: float = LEAST_COSINE
    ) -> LicenceModel:
        model = LicenceModel([], documents, frequency, least)
        for name in sorted(templates):
            for form in templates[name]:
                counts = Counter(terms(form))
                row = {t: n * model.weight(t) for t, n in counts.items()}
                norm = math.sqrt(sum(x * x for x in row.values()))
                vector = {t: x / norm for t, x in row.items()}
                anchors, left = set(), 1.0
                for term in sorted(vector, key=lambda t: (-vector[t], t)):
                    if left < least * least - 1e-9:
                        break
                    anchors.add(term)
                    left -= vector[term] ** 2
                model.forms.append(Form(name, sum(counts.values()), vector, frozenset(anchors)))
        return model

    def weight(self, term: str) -> float:
        return math.log((1 + self.documents) / (1 + int(self.frequency[term_bucket(term)]))) + 0.1

    @cached_property
    def anchored(self) -> dict[str, list[int]]:
        """The forms that a term is an anchor of."""
        found: dict[str, list[int]] = {}
        for k, form in enumerate(self.forms):
            for term in form.anchors:
                found.setdefault(term, []).append(k)
        return found

    def best_window(self, form: Form, words: list[str], start: int, end: int) -> float:
        """The highest cosine to a form of its length in words[start:end], by counts that slide along."""
        length = min(form.length, end - start)
        weight = {t: self.weight(t) ** 2 for t in set(words[start:end])}
        root = {t: math.sqrt(x) * form.vector.get(t, 0.0) for t, x in weight.items()}
        counts: Counter[str] = Counter()
        dot = squares = best = 0.0
        for at in range(start, end):
            term = words[at]
            squares += (2 * counts[term] + 1) * weight[term]
            dot += root[term]
            counts[term] += 1
            if at - start >= length:
                gone = words[at - length]
                counts[gone] -= 1
                squares -= (2 * counts[gone] + 1) * weight[gone]
                dot -= root[gone]
            if at - start >= length - 1:
                best = max(best, dot / math.sqrt(squares))
        return best

    def scan(self, text: str) -> tuple[str | None, float, int, int]:
        """Best statement in a whole text: licence, cosine, its words, and the words of the text.

        A statement is a run of as many words as the template has, anywhere, across lines. All runs with
        an anchor of the template are looked at. Of equal cosines the longest counts, then the first name.
        """
        words = terms(text)
        anchored = self.anchored
        places: dict[int, list[int]] = {}
        if not anchored.keys().isdisjoint(words):
            for at, word in enumerate(words):
                for k in anchored.get(word, ()):
                    places.setdefault(k, []).append(at)
        found = (0.0, 0, "")
        for k in sorted(places):
            form = self.forms[k]
            length, spans = min(form.length, len(words)), []
            for at in places[k]:
                start, end = max(0, at - length + 1), min(len(words), at + length)
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = end
                else:
                    spans.append([start, end])
            for start, end in spans:
                shared = sum(form.vector[t] ** 2 for t in form.vector.keys() & set(words[start:end]))
                if shared < self.least * self.least - 1e-9:
                    continue
                cosine = round(min(1.0, self.best_window(form, words, start, end)), 9)
                if cosine >= self.least and (cosine, length) > found[:2]:
                    found = (cosine, length, form.name)
        return found[2] or None, found[0], found[1], len(words)


def _fit(files: DataFrame, templates: dict[str, list[str]], least_cosine: float) -> LicenceModel:
    """Document frequencies of all terms over all files; tasks send one row per bucket of terms."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << TERM_BITS, np.int64)
        seen: Counter[str] = Counter()

        def take() -> None:
            np.add.at(total, [term_bucket(t) for t in seen], list(seen.values()))
            seen.clear()

        for batch in batches:
            for text in batch["text"]:
                seen.update(set(terms(text or "")))
                if len(seen) > 200_000:
                    take()
        if seen:
            take()
        held = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": held, "n": total[held]})

    counts = files.select("text").mapInPandas(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    frequency = np.zeros(1 << TERM_BITS, np.int64)
    for row in counts.toLocalIterator():
        frequency[row.bucket] = row.n
    return LicenceModel.of(templates, files.count(), frequency, least_cosine)


def stated_licences(
    files: DataFrame, templates: dict[str, list[str]] | None = None, least_cosine: float = LEAST_COSINE
) -> DataFrame:
    """``files`` with own_licence, cosine, and statement_words and text_words, which are numbers of words, instead of text."""
    model = files.sparkSession.sparkContext.broadcast(_fit(files, templates or TEMPLATES, least_cosine))

    def scan(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            found = [model.value.scan(text or "") for text in texts]
            yield pd.DataFrame(found, columns=["name", "cosine", "words", "total"])

    scanned = F.pandas_udf(scan, "name string, cosine double, words long, total long")
    rows = (
        files.drop("own_licence", "cosine", *WORDS)
        .withColumn("__s", scanned("text"))
        .drop("text")
        .withColumn("own_licence", F.col("__s.name"))
        .withColumn("cosine", F.col("__s.cosine"))
        .withColumn("statement_words", F.col("__s.words"))
        .withColumn("text_words", F.col("__s.total"))
    )
    return stage(rows.drop("__s"), "stated")


def scan_licences(
    files: DataFrame, templates: dict[str, list[str]] | None = None, least_cosine: float = LEAST_COSINE
) -> DataFrame:
    """``files`` (path, text, ...) with own_licence, cosine, licence_file, licence and inherited_from added, text left out.

    A file's own licence is the template nearest to a statement anywhere in its text, if the cosine
    of their TF-IDF vectors is ``least_cosine`` or more; ``cosine`` is 0 without one. A statement has as many words as its
    template. Licences of directories are as in ``inherit_licences``.

    Null or empty texts state nothing. Repeated paths are files of their own. An empty table gives no rows;
    other columns stay, save those with the names added, which are replaced.
    """
    return inherit_licences(stated_licences(files.drop(*ADDED), templates, least_cosine))


def inherit_licences(stated: DataFrame) -> DataFrame:
    """Rows of ``stated_licences`` that have a path, with licence_file, licence and inherited_from added.

    A licence file has such a
    name, or is a statement for half its words; it licenses its directory: files of such names
    come first, then the highest cosine, then the licence's name. A file without a licence of its own inherits from the nearest directory
    above it that is licensed, up to the root, whose files have no slash in their path or one in front: directories, not
    files, are joined to their ancestors. A null path has no directory. Other columns stay, but for ``statement_words`` and
    ``text_words``.
    """
    mostly = F.col("statement_words") * 2 >= F.col("text_words")
    named = F.coalesce(F.col("path").rlike(_LICENCE_FILE), F.lit(False))
    rows = (
        stated.drop("licence_file", "licence", "inherited_from")
        .withColumn("licence_file", F.col("own_licence").isNotNull() & (named | mostly))
        .withColumn("__named", named)
        # the root's own files have no directory in their path
        .withColumn("__dir", F.when(F.contains("path", F.lit("/")), F.regexp_replace("path", "/[^/]*$", "")).when(F.col("path").isNotNull(), ""))
        .drop(*WORDS)
    )
    best = F.min(F.struct(~F.col("__named"), -F.round("cosine", 6), F.col("own_licence"))).alias("best")
    licensed = rows.where("licence_file AND __dir IS NOT NULL").groupBy("__dir").agg(best)
    licensed = licensed.select(F.col("__dir").alias("above"), F.col("best.own_licence").alias("licence"))
    directories = rows.where("__dir IS NOT NULL").groupBy("__dir").agg(F.count("*").alias("__files"))
    names = F.split("__dir", "/")
    levels = F.transform(F.sequence(F.lit(1), F.size(names)), lambda n: F.array_join(F.slice(names, 1, n), "/"))
    levels = F.array_distinct(F.concat(F.array(F.lit("")), levels))
    above = directories.select("__dir", "__files", F.explode(levels).alias("above"))
    nearest = above.join(licensed, "above").groupBy("__dir", "__files").agg(
        F.max_by(F.struct("licence", "above"), F.length("above")).alias("from")
    )
    nearest = stage(nearest.select("__dir", "__files", F.col("from.licence").alias("__licence"), F.col("from.above").alias("__above")), "nearest")
    found = attach_groups(rows, nearest, ["__dir"], "__files", rows.count())
    inherits = F.col("own_licence").isNull()
    kept = [c for c in rows.columns if c not in ("__named", "__dir")]
    return found.select(
        *kept,
        F.coalesce("own_licence", "__licence").alias("licence"),
        F.when(inherits, F.col("__above")).alias("inherited_from"),
    )
