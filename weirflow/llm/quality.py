"""A quality classifier by attention-based multiple-instance learning.

A document is a bag of passages, of which only the bag has a label. Every passage of the
whole text is measured and encoded; gated attention (a tanh branch times a sigmoid
branch) gives each a weight within its document; the weighted sum of the encodings is the
document's representation, and a logistic unit scores it. All parts are learned together
from the document labels, so the attention finds the passages that decide.

Learning uses at most ``SAMPLE`` labelled rows, in order of a hash of their ids. Their
passages are measured in Spark; the driver fits the small network to those numbers.
Scoring runs over all rows in Arrow batches.

Defined results: a null or empty text is one passage without words; repeated rows score
alike; without labels of both classes the score is the share of good labels, or one half;
rows of ``labels`` with nulls teach nothing; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import fold, stored

SAMPLE = 5_000
PASSAGE = 100  # words
ENCODED, GATE = 12, 8
STEPS, RATE, DECAY = 400, 0.02, 1e-4
SEED = 7

_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = b".,;:'\"?()"
_SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in b".,;:'\"?()!|")
_BARS = b"|"
_SHOUTS = b"!"
_HIGH = bytes(range(128, 256))
MEASURES = 12


def measures(text: str | None) -> np.ndarray:
    """One row of measures per passage."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    rows = []
    for start in range(0, max(1, len(words)), PASSAGE):
        part = words[start : start + PASSAGE]
        own = b" ".join(part)
        n, size = max(1, len(part)), max(1, len(own))

        def share(of: bytes) -> float:
            return (len(own) - len(own.translate(None, of))) / size  # noqa: B023

        rows.append((
            share(_UPPER), share(_DIGITS), share(_MARKS), share(_SYMBOLS), share(_BARS), share(_SHOUTS), share(_HIGH),
            sum(map(bytes.__eq__, part, part[1:])) / n,  # a word again at once
            1 - len(set(part)) / n,
            size / n / 10,  # length of words
            np.log1p(len(part)) / 5,
            own.isupper(),
        ))
    return np.array(rows, np.float64)


@dataclass
class Network:
    """Encoder, gated attention and output unit, with the scale of the measures."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """``x`` has the passages of all documents, one after another; ``starts`` their first rows."""
        w = self.weights
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        sizes = np.diff([*starts, len(x)])
        h = np.tanh(x @ w["encode"] + w["encode0"])
        t, g = np.tanh(h @ w["tanh"]), _sigmoid(h @ w["gate"])
        e = (t * g) @ w["attend"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts)
        return {"x": x, "sizes": sizes, "h": h, "t": t, "g": g, "a": a, "z": z, "p": _sigmoid(z @ w["out"] + w["out0"])}

    def gradient(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.weights, self.forward(x, starts)
        d = (f["p"] - y) / len(y)
        spread = np.repeat(d, f["sizes"])
        dh = (spread * f["a"])[:, None] * w["out"]
        # through the softmax of each document
        da = spread * (f["h"] @ w["out"])
        de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, starts), f["sizes"]))
        dt = de[:, None] * w["attend"] * f["g"] * (1 - f["t"] ** 2)
        dg = de[:, None] * w["attend"] * f["t"] * f["g"] * (1 - f["g"])
        dh = (dh + dt @ w["tanh"].T + dg @ w["gate"].T) * (1 - f["h"] ** 2)
        return {
            "encode": f["x"].T @ dh, "encode0": dh.sum(0), "tanh": f["h"].T @ dt, "gate": f["h"].T @ dg,
            "attend": (f["t"] * f["g"]).T @ de, "out": f["z"].T @ d, "out0": np.array(d.sum()),
        }

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        parts = [measures(t) for t in texts]
        starts = np.cumsum([0, *map(len, parts)])[:-1]
        return self.forward(np.concatenate(parts), starts)["p"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def learn(bags: list[np.ndarray], labels: np.ndarray) -> Network:
    """A network fitted to labelled bags of measures."""
    rng = np.random.default_rng(SEED)

    def start(*shape: int) -> np.ndarray:
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

    share = float(np.clip(labels.mean(), 0.01, 0.99)) if len(labels) else 0.5
    x = np.concatenate(bags) if bags else np.zeros((1, MEASURES))
    net = Network(
        x.mean(0), x.std(0) + 1e-3,
        {
            "encode": start(MEASURES, ENCODED), "encode0": np.zeros(ENCODED), "tanh": start(ENCODED, GATE),
            "gate": start(ENCODED, GATE), "attend": start(GATE), "out": start(ENCODED),
            "out0": np.array(np.log(share / (1 - share))),
        },
    )
    if len(set(labels.tolist())) < 2:
        net.weights["out"] = np.zeros(ENCODED)
        return net
    starts = np.cumsum([0, *map(len, bags)])[:-1]
    first = {k: np.zeros_like(v) for k, v in net.weights.items()}
    second = {k: np.zeros_like(v) for k, v in net.weights.items()}
    for step in range(1, STEPS + 1):
        for k, g in net.gradient(x, starts, labels).items():
            g = g + DECAY * net.weights[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            net.weights[k] = net.weights[k] - RATE * (first[k] / (1 - 0.9**step)) / (
                np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8
            )
    return net


def fit(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> Network:
    """A network learned from labelled rows whose fold is not ``held``."""
    known = labels.filter((fold("doc_id", folds) != held) & F.col("quality").isin(0, 1))
    known = known.select(F.col("doc_id").alias("label_id"), "quality").distinct()
    chosen = known.orderBy(F.xxhash64("label_id"), "label_id").limit(SAMPLE)
    sample = stored(
        docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("text", "quality"),
        "quality-sample",
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                bags = [measures(t).ravel().tolist() for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(bags, pa.list_(pa.float64())), part.column(1)], ["bag", "quality"])

    rows = sample.select("text", F.col("quality").cast("int").alias("quality")).mapInArrow(
        measure, "bag ARRAY<DOUBLE>, quality INT"
    ).toArrow()
    bags = [np.array(b).reshape(-1, MEASURES) for b in rows.column("bag").to_pylist()]
    return learn(bags, np.array(rows.column("quality").to_pylist(), float))


def score(network: Network) -> Column:
    """The score of column ``text``, 0 to 1."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            own = [t if isinstance(t, str) else None for t in texts]
            parts = [network.score(own[k : k + 500]) for k in range(0, len(own), 500)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return run(F.col("text"))
