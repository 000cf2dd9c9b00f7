"""Language identification by sparse multinomial logistic regression.

Texts become TF-IDF weights of hashed character n-grams. Document frequencies
are counted over all training documents; the weights are learned on a bounded
sample per language by follow-the-regularised-leader with an L1 and an L2
penalty, which leaves most of them at zero; a temperature fitted on a part of
the sample that was not learned from calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from homematch.llm.common import id_remainder

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
#: Labelled documents a language gives at most to the learning sample.
SAMPLE_PER_LANGUAGE = 1500
#: Characters read at a time; counts of a text are summed over these.
BLOCK = 200_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.5
#: Different languages that a model takes at most; each has a column of weights.
MOST_LANGUAGES = 1000
#: Weight of the calibration's prior, which draws the temperature to 1 where few texts or no errors speak.
PRIOR = 4.0
UNKNOWN = "und"


def has_letter(text: str) -> bool:
    """Whether a character of a text is a letter by its Unicode category; number signs such as halves are none."""
    return any(map(str.isalpha, text))


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed 1-, 2- and 3-grams of a whole text, letter case ignored."""
    low = text.lower()
    counts = np.zeros(BUCKETS, np.int64)
    shift = np.uint32(32 - BUCKET_BITS)
    for start in range(0, len(low), BLOCK):
        chars = np.frombuffer(low[start : start + BLOCK + 2].encode("utf-32-le", "surrogatepass"), np.uint32)
        own = min(BLOCK, len(low) - start)
        one = chars * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ chars[1:]) * np.uint32(0x85EBCA77)
        three = (two[:-1] ^ chars[2:]) * np.uint32(0xC2B2AE3D)
        counts += np.bincount(np.concatenate([one[:own], two[:own], three[:own]]) >> shift, minlength=BUCKETS)
    return counts


def weighted(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets present and their TF-IDF weights, of unit length."""
    at = np.flatnonzero(counts)
    x = np.log1p(counts[at]) * idf[at]
    return at, x / max(np.sqrt(x @ x), 1e-12)


class Sample:
    """Texts to learn from as (buckets, weights, label), worked out anew each time from their counts, which take little memory."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray, int]], idf: np.ndarray):
        self.rows, self.idf = rows, idf

    @staticmethod
    def row(text: str, label: int) -> tuple[np.ndarray, np.ndarray, int]:
        counts = gram_counts(text)
        at = np.flatnonzero(counts)
        return at.astype(np.uint16), counts[at].astype(np.min_scalar_type(counts.max(initial=0))), label

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray, int]:
        at, held, label = self.rows[i]
        counts = np.zeros(BUCKETS, np.int64)
        counts[at] = held
        return *weighted(counts, self.idf), label


@dataclass
class LanguageModel:
    """Languages, document weights, sparse weights by bucket, intercepts and temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    intercepts: np.ndarray
    temperature: float

    def logits(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[at] + self.intercepts

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        p = softmax(self.logits(*weighted(gram_counts(text), self.idf)) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """In how many of all texts each bucket occurs. Tasks count on their own; the result has a fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for text in batch.column(0).slice(start, 256).to_pylist():
                    held += gram_counts(text) > 0
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(held[at], pa.int64())], ["bucket", "n"])

    total = np.zeros(BUCKETS)
    for row in docs.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"]] = row["n"]
    return total


def learned(rows: Sequence[tuple[np.ndarray, np.ndarray, int]], classes: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and intercepts by follow-the-regularised-leader with elastic-net penalty."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))
    bias, bias_n = np.zeros(classes), np.zeros(classes)

    def closed_form(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return -np.sign(z) * np.maximum(np.abs(z) - L1, 0) / ((BETA + np.sqrt(n)) / ALPHA + L2)

    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at, x, label = rows[i]
            w = closed_form(z[at], n[at])
            error = softmax(x @ w + bias)
            error[label] -= 1
            g = x[:, None] * error
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
            bias_n += error * error
            bias -= ALPHA * error / (BETA + np.sqrt(bias_n))
    return closed_form(z, n), bias


def fitted_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Temperature of least log loss under a prior around 1, by golden-section search on its logarithm."""

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))
        return -float(np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).sum()) + PRIOR * t * t

    low, high, ratio = -4.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, seed: int = 4) -> LanguageModel:
    """Model from all rows of (doc_id, text, lang) without nulls in text and lang.

    Frequencies are counted over every row. The driver gets the sample of at
    most about ``per_language`` texts a language, chosen by hash; a fifth of it
    is kept for the temperature.
    """
    per = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(per) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} different languages")
    languages = sorted(per)
    if not languages:
        return LanguageModel([], np.zeros(BUCKETS), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    idf = np.log((1 + sum(per.values())) / (1 + document_frequencies(labelled)))
    share = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 30))
    limit = F.lit(1 << 30)
    for language, n in per.items():
        if n > per_language:
            limit = F.when(F.col("lang") == language, F.lit(int((1 << 30) * per_language / n))).otherwise(limit)
    sample = labelled.where(share < limit).select("text", "lang").withColumn("_order", F.xxhash64(F.lit(seed + 1), "text", "lang"))
    rows = sorted((r["_order"], r["lang"], r["text"]) for r in sample.toLocalIterator())
    number = {language: i for i, language in enumerate(languages)}
    ready = [Sample.row(text, number[lang]) for _, lang, text in rows]
    held, used = Sample(ready[::5], idf), Sample([r for i, r in enumerate(ready) if i % 5] or ready, idf)
    model = LanguageModel(languages, idf, *learned(used, len(languages), seed), 1.0)
    model.temperature = fitted_temperature(np.array([model.logits(at, x) for at, x, _ in held]), np.array([label for *_, label in held]))
    return model


def predictor(docs: DataFrame, model: LanguageModel):
    """Column function that gives (lang_pred, score) of a text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        use = shared.value
        return pd.DataFrame([use.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict


def training_rows(docs: DataFrame, key: str, text: str, lang: str, divisor: int, held: int) -> DataFrame:
    """Documents a model may learn from."""
    rows = docs.where(id_remainder(key, divisor) != held).select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    return rows.where("text IS NOT NULL AND lang IS NOT NULL")


def identify_languages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", divisor: int = 3, held: int = 1,
) -> DataFrame:
    """Predicted language and calibrated probability of every text.

    Learns from rows whose crc32(key as text) mod ``divisor`` is not ``held``
    and whose text and language are present. Texts that are null, empty or
    without a letter are ``und`` with score 0, as are all if there is nothing to
    learn from. Of languages with equal probability the first in the order of
    their names counts. Texts of any length are read whole, in blocks. Over
    ``MOST_LANGUAGES`` different languages raise an error. Repeated rows are judged each; an empty table gives no rows;
    other columns, whatever their names, are ignored.
    """
    predict = predictor(docs, train(training_rows(docs, key, text, lang, divisor, held)))
    found = docs.select(docs[key].alias("doc_id"), (id_remainder(key, divisor) == held).alias("held_out"), predict(docs[text].cast("string")).alias("_p"))
    return found.select("doc_id", "held_out", "_p.lang_pred", "_p.score")
