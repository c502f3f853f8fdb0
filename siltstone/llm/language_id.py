"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import id_remainder

UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")
_CHUNK_CHARS = 400_000
_BATCH_ENTRIES = 1_000_000


def ngram_buckets(text: str, bits: int) -> Iterator[np.ndarray]:
    """Hashed 1-, 2- and 3-grams of the whole lower-cased text, white space as one blank, blank at both ends.

    A long text comes in pieces of _CHUNK_CHARS; each begins with the two characters before it, so no n-gram is lost or
    counted twice.
    """
    padded = " " + " ".join(text.lower().split()) + " "
    for at in range(0, len(padded), _CHUNK_CHARS):
        seen = min(at, 2)
        piece = padded[at - seen : at + _CHUNK_CHARS]
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        one = codes * np.uint64(0x9E3779B97F4A7C15)
        two = (one[:-1] ^ (one[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + one[1:]
        three = (two[:-1] ^ (two[:-1] >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) + one[2:]
        mixed = np.concatenate([one[seen:], two[max(0, seen - 1) :] * np.uint64(3), three * np.uint64(5)])
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        yield (mixed >> np.uint64(64 - bits)).astype(np.int32)


@dataclass(frozen=True)
class NaiveBayes:
    """Languages in order, and log-probabilities by bucket and language with the log-priors."""

    languages: list[str]
    log_probability: np.ndarray
    log_prior: np.ndarray
    bits: int

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """Most probable language and its posterior probability; ties go to the first in order.

        A batch is one sparse matrix of n-grams by text, in row order: rows of the
        log-probability matrix are gathered and summed text by text.
        """
        readable = [bool(self.languages and text is not None and _LETTER.search(text)) for text in texts]
        totals = np.tile(self.log_prior.astype(np.float64), (len(texts), 1))
        rows: list[int] = []
        entries: list[np.ndarray] = []

        def add() -> None:
            if entries:
                starts = np.cumsum([0, *map(len, entries[:-1])])
                gathered = self.log_probability[np.concatenate(entries)]
                np.add.at(totals, rows, np.add.reduceat(gathered, starts, axis=0, dtype=np.float64))
                rows.clear()
                entries.clear()

        held = 0
        for row, text in enumerate(texts):
            for buckets in ngram_buckets(text, self.bits) if readable[row] else ():
                rows.append(row)
                entries.append(buckets)
                held += len(entries[-1])
                if held > _BATCH_ENTRIES:
                    add()
                    held = 0
        add()
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        best = totals.argmax(axis=1)
        odds = np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
        found = [self.languages[k] if known else UNDETERMINED for k, known in zip(best, readable)]
        return found, np.where(readable, 1.0 / odds, 0.0)


def train_language_model(
    labelled: DataFrame, bits: int = 16, sample_rows: int = 20_000, smoothing: float = 0.5
) -> NaiveBayes:
    """Fit on rows with (text, lang, pick); ``pick`` is any fixed hash of the row.

    About ``sample_rows`` rows are read, the same share of each language but all rows of a
    language with few; a row is chosen by its hash. Tasks send counts by language and
    bucket; the model has languages x 2**``bits`` numbers, whatever the input.
    """
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return NaiveBayes([], np.zeros((1 << bits, 0), np.float32), np.zeros(0), bits)
    each = max(1, sample_rows // len(sizes))
    overall = sample_rows / max(sample_rows, sum(sizes.values()))
    # at least ``each`` rows of a language where it has them
    share = {lang: min(1.0, max(overall, each / n)) for lang, n in sizes.items()}
    shares = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])
    chosen = labelled.where(F.pmod("pick", F.lit(1_000_000)) < F.element_at(shares, F.col("lang")) * 1_000_000)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                if lang not in held:
                    held[lang] = np.zeros(1 << bits, np.int64)
                for buckets in ngram_buckets(text, bits):
                    held[lang] += np.bincount(buckets, minlength=1 << bits)
        for lang, counts in held.items():
            seen = np.flatnonzero(counts)
            yield pd.DataFrame({"lang": lang, "bucket": seen, "n": counts[seen]})

    counts = (
        chosen.select("text", "lang")
        .mapInPandas(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(sizes)
    matrix = np.full((1 << bits, len(languages)), smoothing)
    place = {lang: k for k, lang in enumerate(languages)}
    matrix[counts["bucket"].to_numpy(np.int64), counts["lang"].map(place).to_numpy(np.int64)] += counts["n"]
    matrix = np.log(matrix) - np.log(matrix.sum(axis=0))
    prior = np.log(np.array([sizes[lang] for lang in languages]) / sum(sizes.values()))
    return NaiveBayes(languages, matrix.astype(np.float32), prior, bits)


def _predicted(docs: DataFrame, bits: int, sample_rows: int) -> DataFrame:
    """``docs`` with the structure __found: held_out, lang_pred, score."""
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    labelled = docs.where(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull())
    labelled = labelled.select("text", "lang", F.xxhash64("doc_id", "text").alias("pick"))
    model = docs.sparkSession.sparkContext.broadcast(train_language_model(labelled, bits, sample_rows))

    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            found, scores = model.value.predict(list(part))
            yield pd.DataFrame({"lang_pred": found, "score": scores})

    predicted = F.pandas_udf(predict, "lang_pred string, score double")
    return docs.withColumn("__found", predicted("text").withField("held_out", held_out))


def identify_languages(docs: DataFrame, bits: int = 16, sample_rows: int = 20_000) -> DataFrame:
    """``docs`` with held_out, lang_pred and score added; columns of such names are replaced.

    The model is fitted on text and lang of documents with crc32(doc_id) mod 4 other than
    2 and a lang that is not null; those at 2 are ``held_out``. A prediction uses the text alone.
    A text that is null or has no letter is ``und`` with score 0, as is every text where no
    language is learned. Whole texts are read; a null doc_id counts as empty text
    in the remainder. An empty table gives no rows.
    """
    added = ["held_out", "lang_pred", "score"]
    found = _predicted(docs, bits, sample_rows)
    return found.select(*[c for c in docs.columns if c not in added], *[f"__found.{c}" for c in added])


def keep_identified(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` in a learned language of at least ``least_score``, with their columns as they were."""
    found = _predicted(docs, 16, 20_000)
    sure = (F.col("__found.lang_pred") != UNDETERMINED) & (F.col("__found.score") >= least_score)
    return found.where(sure).select(*docs.columns)
