"""Document fingerprints by consistent weighted sampling.

A document is the multiset of its words, lower-cased (A-Z) and without ASCII marks around
them; a word's weight is how often it stands there. For each of ``SAMPLES`` samples a word draws
two gamma values and one uniform value from its own hash, the same in every document, and the
word whose draw is smallest at its weight is the sample, together with the level at which it
was drawn. Two documents agree in a sample with a probability equal to their generalised
Jaccard similarity, the sum of the smaller weights over the sum of the larger. A sample is kept
as 16 bits of a hash of word and level, so that unequal samples agree once in 65,536.

The edited text of a document, half of which comes from the next one, needs its neighbour by
``doc_id``. Documents are cut into ranges at quantiles of ``doc_id``; the first document of
each range is also sent to the range before it, and the first of all to the last. One
exchange brings a range together, sorted from its last document to its first, so that the next
document is always the one just read: a task holds two texts and one small batch.

Defined results: a null text is an empty one; a text without words has a fingerprint of zeros
and is alike to another such text only; rows that repeat a ``doc_id`` are not neighbours of each
other: the next document is that of the next larger id, of several the least text; after the
largest id comes the smallest; rows without ``doc_id`` come before all others, as one id; a single
id is its own next document; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import shuffle_width

SAMPLES = 64
BATCH = 64  # texts whose words are drawn together
BATCH_CHARS = 1 << 20
WORDS = 512  # words drawn, or compared, at once

_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_STEPS = np.array([0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1 for k in range(1 << 10)], np.uint64)


def words(text: str) -> Counter:
    """The words of a text and how often they occur; a word of marks alone stays as it is."""
    found = Counter(text.encode("utf-8", "surrogatepass").lower().split())
    for word in [w for w in found if w[0] in _MARKS or w[-1] in _MARKS]:
        if plain := word.strip(_MARKS):
            found[plain] += found.pop(word)
    return found


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(own: list[bytes]) -> np.ndarray:
    array = np.empty(len(own), object)
    array[:] = own
    return pd.util.hash_array(array, categorize=False)


class Draws:
    """What some words draw in each sample: gamma values r and c (as logarithm) and a uniform value."""

    def __init__(self, own: list[bytes], samples: int = SAMPLES):
        self.hashes = hashes(own)
        self.samples = samples
        shape = (len(own), samples)
        self.r, self.log_c, self.beta = (np.empty(shape, np.float32) for _ in range(3))
        for start in range(0, len(own), WORDS):
            at = slice(start, start + WORDS)
            seeds = self.hashes[at, None] + _STEPS[None, :samples]
            one, two = mixed(seeds), mixed(seeds ^ np.uint64(0x5851F42D4C957F2D))
            parts = [(x >> np.uint64(s)) & np.uint64(0x1FFFFF) for x in (one, two) for s in (0, 21, 42)]
            # uniform in (0, 1); a gamma value of shape 2 is minus the logarithm of a product of two
            u = [(p.astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-21) for p in parts[:5]]
            self.r[at] = -np.log(u[0] * u[1])
            self.log_c[at] = np.log(-np.log(u[2] * u[3]))
            self.beta[at] = u[4]

    def fingerprint(self, own: np.ndarray, counts: np.ndarray) -> bytes:
        """The samples of a document that has these words so often."""
        best = np.full(self.samples, np.inf, np.float32)
        code = np.zeros(self.samples, np.uint64)
        every = np.arange(self.samples)
        logs = np.log(counts).astype(np.float32)[:, None]
        for start in range(0, len(own), 8 * WORDS):
            some = own[start : start + 8 * WORDS]
            r, beta = self.r[some], self.beta[some]
            level = np.floor(logs[start : start + 8 * WORDS] / r + beta)
            draw = self.log_c[some] - r * (level - beta + 1)
            least = draw.argmin(axis=0)
            drawn = draw[least, every]
            new = mixed(self.hashes[some[least]] + mixed(level[least, every].astype(np.int64).astype(np.uint64) + every.astype(np.uint64)))
            code = np.where(drawn < best, new, code)
            best = np.minimum(best, drawn)
        return (code >> np.uint64(48)).astype(">u2").tobytes()


def fingerprints(texts: list[str], samples: int = SAMPLES) -> list[bytes]:
    """The fingerprint of each text; words that several texts share are drawn once."""
    counted = [words(t) for t in texts]
    places: dict[bytes, int] = {}
    for own in counted:
        for word in own:
            places.setdefault(word, len(places))
    draws = Draws(list(places), samples)
    return [
        draws.fingerprint(
            np.fromiter(map(places.__getitem__, own), np.int64, len(own)),
            np.fromiter(own.values(), np.float64, len(own)),
        )
        for own in counted
    ]


def likeness(a: bytes, b: bytes) -> float:
    """The share of samples in which two fingerprints agree."""
    return float(np.mean(np.frombuffer(a, ">u2") == np.frombuffer(b, ">u2")))


def edited(text: str, following: str) -> str:
    """``text``, its last half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def signed(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Per row: doc_id and the fingerprint of its text, as hexadecimal digits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                found = fingerprints([t or "" for t in part.column(1).to_pylist()], samples)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([f.hex() for f in found], pa.string())], ["doc_id", "fingerprint"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint STRING")


def _place(key: Column, limits: list[int]) -> Column:
    """How many of the sorted limits are at most the key: first among every so many, then among those."""
    if not limits:
        return F.lit(0)
    step = math.isqrt(len(limits) - 1) + 1
    chunks = [limits[k : k + step] for k in range(0, len(limits), step)]

    def below(values) -> Column:
        return F.size(F.filter(values, lambda x: x <= key))

    chunk = below(F.array(*(F.lit(c[0]) for c in chunks)))
    inner = F.element_at(F.array(*(F.array(*map(F.lit, c)) for c in chunks)), chunk)
    return F.when(chunk == 0, 0).otherwise((chunk - 1) * step + below(inner))


def _ranges(docs: DataFrame) -> DataFrame:
    """``docs`` as (range, copy, doc_id, text): each range with the document that follows it."""
    spark, parts = docs.sparkSession, shuffle_width(docs.sparkSession)
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))  # no id: before all
    rows = docs.select(key.alias("key"), F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shares = [k / parts for k in range(1, parts)]
    limits = sorted({int(x) for x in rows.select("doc_id").approxQuantile("doc_id", shares, 0.1 / parts)}) if shares else []
    rows = rows.withColumn("range", _place(F.col("key"), limits))
    firsts = rows.groupBy("range").agg(F.min("key").alias("first")).orderBy("range").collect()  # one row per range
    if not firsts:
        return rows.withColumn("copy", F.lit(False))
    before = [firsts[k - 1]["range"] for k in range(len(firsts))]  # of the first range: the last
    copies = spark.createDataFrame([(r["first"], int(b)) for r, b in zip(firsts, before)], "key BIGINT, to INT")
    own = F.struct(F.col("range"), F.lit(False).alias("copy"))
    moved = F.struct(F.col("to").alias("range"), F.lit(True).alias("copy"))
    places = F.filter(F.array(own, moved), lambda x: x["range"].isNotNull())
    return (
        rows.join(F.broadcast(copies), "key", "left")
        .select(F.explode(places).alias("place"), "key", "doc_id", "text")
        .select("place.range", "place.copy", "key", "doc_id", "text")
        .repartitionByRange(parts, "range")
        .sortWithinPartitions("range", F.col("copy").desc(), F.col("key").desc(), "text")
    )


def with_edits(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""

    class Sweep:
        """Reads a range from its last document to its first."""

        def __init__(self):
            self.range = None
            self.key = None
            self.own: tuple[str, bytes] | None = None  # the least text of the id at hand
            self.following: tuple[str, bytes] | None = None  # and of the id after it

        def work(self, rows: list[tuple]) -> tuple[list, list, list, list, list, list, list]:
            """The results of some rows in order; copies of a following document give none."""
            texts, at, places = [], [], {}

            def place(text: str) -> int:
                if text not in places:
                    places[text] = len(texts)
                    texts.append(text)
                return places[text]

            for where, copy, key, _, text in rows:
                if where != self.range:
                    self.range, self.key, self.own, self.following = where, None, None, None
                if (copy, key) != self.key:
                    self.key, self.following, self.own = (copy, key), self.own, text
                following = self.following if self.following is not None else text
                if not copy:
                    new = edited(text, following)
                    at.append((place(text), place(new), place(following)))
                else:
                    at.append(None)
            found = fingerprints(texts, samples)
            out: tuple = ([], [], [], [], [], [], [])
            for (_, copy, _, doc_id, text), where in zip(rows, at):
                if copy:
                    continue
                own, new, following = (found[k] for k in where)
                for column, x in zip(out, (
                    doc_id, len(text), hashlib.sha256(texts[where[1]].encode("utf-8", "surrogatepass")).hexdigest(),
                    own.hex(), new.hex(), likeness(own, new), likeness(own, following),
                )):
                    column.append(x)
            return out

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = Sweep()
        for batch in batches:
            rows, size = [], 0
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                rows.append(row)
                size += len(row[-1])
                if len(rows) == BATCH or size > BATCH_CHARS:
                    yield _batch(sweep.work(rows))
                    rows, size = [], 0
            if rows:
                yield _batch(sweep.work(rows))

    def _batch(columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    ranges = _ranges(docs).select("range", "copy", "key", "doc_id", "text")
    return ranges.mapInArrow(
        run,
        "doc_id BIGINT, n_chars BIGINT, edited_sha256 STRING, fingerprint STRING, edited_fingerprint STRING, "
        "near_edited DOUBLE, near_next DOUBLE",
    )
