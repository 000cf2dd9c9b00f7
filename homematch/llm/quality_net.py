"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, filters stand at every byte of the whole text, and their
answers are pooled to a maximum in overlapping chunks that cover it. The largest
and the mean chunk answers of all filters go through a small dense layer to one
probability. The weights are learned on a bounded sample of labelled texts, in
a number of updates that does not fall with the sample.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from homematch.llm.common import id_remainder, sampled

#: Embedding size, bytes a filter sees, filters, hidden units.
EMBED, REACH, FILTERS, HIDDEN = 8, 8, 32, 16
#: Bytes pooled first; a chunk is two neighbouring runs of ``HALF`` bytes, so chunks overlap by half.
HALF = 64
#: Bytes scored at a time.
BLOCK = HALF * 256
#: Labelled documents the learning sample has at most, about.
SAMPLE_ROWS = 3000
#: Passes over the sample, and updates that are made at least.
EPOCHS, UPDATES, BATCH, RATE = 4, 300, 16, 0.004
THRESHOLD = 0.7


@dataclass
class QualityNet:
    """Weights, all in one dictionary so that the optimiser treats them alike."""

    w: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, seed: int) -> QualityNet:
        r = np.random.default_rng(seed)
        return cls({
            "embed": r.normal(0, 0.5, (256, EMBED)).astype(np.float32),
            "filters": r.normal(0, 0.15, (REACH, EMBED, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "dense": r.normal(0, 0.15, (2 * FILTERS, HIDDEN)).astype(np.float32),
            "dense_bias": np.zeros(HIDDEN, np.float32),
            "out": r.normal(0, 0.3, HIDDEN).astype(np.float32),
            "out_bias": np.zeros(1, np.float32),
        })

    def padded(self, data: np.ndarray) -> np.ndarray:
        """A text's bytes, padded by zero bytes to whole half chunks and the filters' reach beyond."""
        count = max(1, -(-data.size // HALF)) * HALF + REACH - 1
        out = np.zeros(count, np.uint8)
        out[: data.size] = data
        return out

    def answers(self, data: np.ndarray) -> np.ndarray:
        """Filter answers at all bytes that have the filters' reach behind them."""
        seen = self.w["embed"][data]
        windows = np.lib.stride_tricks.sliding_window_view(seen.reshape(-1), REACH * EMBED)[::EMBED]
        return np.ascontiguousarray(windows) @ self.w["filters"].reshape(REACH * EMBED, FILTERS)

    def halves(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest answer of each half chunk and the byte where it stands."""
        answers = self.answers(data).reshape(-1, HALF, FILTERS)
        at = answers.argmax(axis=1)
        return np.take_along_axis(answers, at[:, None], 1)[:, 0], at + np.arange(len(answers))[:, None] * HALF

    def half_maxima(self, data: np.ndarray) -> np.ndarray:
        """Largest answer of each half chunk, in blocks so that long texts need no more memory."""
        count = len(data) - REACH + 1
        parts = [
            self.answers(data[start : min(start + BLOCK, count) + REACH - 1]).reshape(-1, HALF, FILTERS).max(axis=1)
            for start in range(0, count, BLOCK)
        ]
        return np.concatenate(parts)

    def hidden(self, pooled: np.ndarray) -> np.ndarray:
        return np.tanh(pooled @ self.w["dense"] + self.w["dense_bias"])

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        seen = np.tanh(chunks + self.w["bias"])
        return np.concatenate([seen.max(axis=0), seen.mean(axis=0)])

    def score(self, text: str | None) -> float:
        """Probability of good quality; also for an empty text, which is one chunk of padding."""
        half = self.half_maxima(self.padded(np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)))
        chunks = np.maximum(half[:-1], half[1:]) if len(half) > 1 else half
        z = self.hidden(self.pooled(chunks)) @ self.w["out"] + self.w["out_bias"][0]
        return float(1 / (1 + np.exp(-np.clip(float(z), -30, 30))))

    def gradients(self, data: np.ndarray, label: int, grad: dict[str, np.ndarray]) -> None:
        """Add the gradients of one text's log loss."""
        w, held = self.w, self.padded(data)
        value, at = self.halves(held)
        if len(value) > 1:
            first = value[:-1] >= value[1:]
            at, value = np.where(first, at[:-1], at[1:]), np.maximum(value[:-1], value[1:])
        seen = np.tanh(value + w["bias"])
        top = seen.argmax(axis=0)
        pooled = np.concatenate([seen.max(axis=0), seen.mean(axis=0)])
        hidden = self.hidden(pooled)
        z = np.clip(hidden @ w["out"] + w["out_bias"][0], -30, 30)
        error = 1 / (1 + np.exp(-z)) - label
        grad["out"] += error * hidden
        grad["out_bias"] += error
        back = error * w["out"] * (1 - hidden**2)
        grad["dense"] += np.outer(pooled, back)
        grad["dense_bias"] += back
        back = w["dense"] @ back
        to_seen = np.repeat(back[None, FILTERS:] / len(seen), len(seen), axis=0)
        to_seen[top, np.arange(FILTERS)] += back[:FILTERS]
        to_answer = (to_seen * (1 - seen**2)).astype(np.float32)
        grad["bias"] += to_answer.sum(axis=0)
        for i in range(REACH):
            codes = held[at + i]  # chunks x filters
            vectors = w["embed"][codes]
            grad["filters"][i] += np.einsum("cfe,cf->ef", vectors, to_answer)
            to_embed = to_answer[:, :, None] * w["filters"][i].T[None]
            places, flat = codes.reshape(-1), to_embed.reshape(-1, EMBED)
            for e in range(EMBED):
                grad["embed"][:, e] += np.bincount(places, flat[:, e], 256)


def fit(texts: list[str], labels: list[int], seed: int = 2) -> QualityNet:
    """Network learned by Adam on whole texts; small samples are passed over more often."""
    net = QualityNet.fresh(seed)
    epochs = max(EPOCHS, -(-UPDATES * BATCH // max(len(texts), 1))) if texts else 0
    data = [np.frombuffer(t.encode("utf-8", "replace"), np.uint8) for t in texts]
    if labels:
        share = min(max(sum(labels) / len(labels), 0.01), 0.99)
        net.w["out_bias"][:] = np.log(share / (1 - share))
    m, v = ({k: np.zeros_like(a) for k, a in net.w.items()} for _ in range(2))
    order, step = np.random.default_rng(seed), 0
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs) + RATE / 10
        shuffled = order.permutation(len(data))
        for start in range(0, len(data), BATCH):
            chosen = shuffled[start : start + BATCH]
            grad = {k: np.zeros_like(a) for k, a in net.w.items()}
            for i in chosen:
                net.gradients(data[i], labels[i], grad)
            step += 1
            for k, g in grad.items():
                g /= len(chosen)
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                net.w[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)
    return net


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, divisor: int, held: int, rows: int = SAMPLE_ROWS, seed: int = 2) -> QualityNet:
    """Network from labelled documents outside the held-out share.

    About ``rows`` labelled documents, chosen by hash, come to the driver. A
    document with labels of both kinds is learned from as each of them.
    """
    known = labels.where(F.col(label).isNotNull() & (id_remainder(key, divisor) != held)).select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).distinct()
    chosen = sampled(known, "_key", rows, known.count(), f"quality{seed}")
    texts = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    found = sorted((r["_key"], r["_label"], r["_text"]) for r in texts.join(chosen, "_key").select("_key", "_label", "_text").toLocalIterator())
    return fit([t for *_, t in found], [y for _, y, _ in found], seed)


def scorer(docs: DataFrame, net: QualityNet):
    """Column function that scores a text."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        use = shared.value
        return pd.Series([use.score(t) for t in texts], dtype="float64")

    return score


def score_quality(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", divisor: int = 4, held: int = 2,
) -> DataFrame:
    """Score of every whole text, and whether it passes.

    Learns from labels whose crc32(key as text) mod ``divisor`` is not ``held``.
    Null texts count as empty and get a score too. Without labels the network is
    the untrained one. Texts of any length are scored whole, in blocks that
    change nothing. Repeated rows are scored each; an empty table gives no
    rows; other columns, whatever their names, are ignored.
    """
    score = scorer(docs, train(docs, labels, key, text, label, divisor, held))
    scored = docs.select(docs[key].alias("doc_id"), (id_remainder(key, divisor) == held).alias("held_out"), score(docs[text].cast("string")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
