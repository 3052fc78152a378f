"""Benchmark decontamination: a BM25 index of test items, searched by every training passage.

Test items are the indexed documents, passages of the training texts the queries. A
passage is two neighbouring stretches of words, each as long as the longest item, so an
item that is copied anywhere lies within one passage. Scores are shares: the BM25 weight
of an item's terms that the passage has, over the weight of all its terms. All items
that reach ``threshold`` are retrieved, by block-max WAND over all passages of a batch
at once: the most common terms form a set that cannot bring any item to the threshold
alone (non-essential lists); the others are looked up as block maxima, summed per passage
and block of items, and only blocks whose sum and common-term bound reach the threshold
are scored item by item. A retrieved item counts as leaked if enough word trigrams of its
question and of its answer stand in the passage. An item's last sentence is taken as its
answer; an item of one sentence is split after three quarters of its words. An item under
``SHORT`` words leaks only where all its words stand in the passage one after the other.

Items are indexed in blocks of at most about ``ITEMS`` items and ``ITEM_WORDS`` words and each
block is searched by all passages, so what is broadcast is bounded however many items there
are. The statistics are those of all items: scores and passages do not depend on the blocks.
Tasks build the blocks' indexes; the driver passes them on one by one, as bytes.

Defined results: null or empty texts have no passages; an item without words
never matches; equal items all match; an item that leaks
several times into a document gives one row, of its best passage; repeated rows are
judged one by one; without items or documents the result is empty; other columns are
ignored.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import free_name, small_side, stored

K1, B = 1.2, 0.75
THRESHOLD = 0.5  # share of an item's own weight
OVERLAP = 0.6  # share of trigrams, of the question and of the answer
SHORT = 8  # items under so many words count only as a whole
ITEMS, ITEM_WORDS = 20_000, 2_000_000  # of a block
BLOCK = 8  # items that share a block maximum
CELLS = 2_000_000  # block sums held at once

_MARKS = bytes(32 if chr(c).isspace() or (c < 128 and not chr(c).isalnum()) else c for c in range(256))
_MARKS = bytes(c if c >= 128 else m for c, m in zip(range(256), _MARKS))


def words(text: str | None) -> list[bytes]:
    """Lower-case words; ASCII marks separate."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_MARKS).split()


def grams(of: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    return {tuple(of[i : i + n]) for i in range(len(of) - n + 1)}


def trigrams(of: list[bytes]) -> set[tuple[bytes, ...]]:
    """The trigrams of some words; fewer than three words are one gram."""
    return grams(of, min(3, len(of))) if of else set()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    sentences = [w for part in re.split(r"(?<=[.?!])\s+|\n+", text) if (w := words(part))]
    if len(sentences) > 1:
        return [w for part in sentences[:-1] for w in part], sentences[-1]
    own = words(text)
    cut = max(1, len(own) * 3 // 4)
    return own[:cut], own[cut:]


class Statistics(NamedTuple):
    """Of all items: their number, mean and greatest length, and the items that have a term."""

    items: int
    mean: float
    longest: int
    df: dict[bytes, int]


class Index:
    """A BM25 inverted index of some items with block maxima; without statistics, those of the items hold."""

    def __init__(self, items: list[tuple[int, str | None]], threshold: float, known: Statistics | None = None):
        kept = [(i, t) for i, t in items if words(t)]
        self.threshold = threshold
        self.ids = [i for i, _ in kept]
        self.parts = [tuple(map(trigrams, question_and_answer(t))) for _, t in kept]
        self.whole = [b" ".join([b"", *own, b""]) if len(own := words(t)) < SHORT else None for _, t in kept]
        counts = [Counter(words(t)) for _, t in kept]
        lengths = [sum(c.values()) for c in counts]
        df = Counter(term for c in counts for term in c)
        if known is None:
            known = Statistics(len(kept), sum(lengths) / max(1, len(lengths)), max(lengths, default=1), df)
        self.stretch, mean = known.longest, known.mean
        self.vocabulary = {term: k for k, term in enumerate(df)}
        self.weights: list[dict[int, float]] = []
        for c, length in zip(counts, lengths):
            own = {
                self.vocabulary[t]: math.log(1 + (known.items - known.df[t] + 0.5) / (known.df[t] + 0.5))
                * n * (K1 + 1) / (n + K1 * (1 - B + B * length / mean))
                for t, n in c.items()
            }
            total = math.fsum(own.values())  # in any order of the terms
            self.weights.append({t: w / total for t, w in own.items()})
        # the most common terms, as long as they leave every item far from the threshold
        rest = np.zeros(len(kept))
        holders = defaultdict(list)
        for i, own in enumerate(self.weights):
            for t, w in own.items():
                holders[t].append((i, w))
        common = set()
        for term, _ in df.most_common():
            t = self.vocabulary[term]
            where = [i for i, _ in holders[t]]
            add = np.array([w for _, w in holders[t]])
            over = rest[where] + add > 0.6 * threshold
            if over.any():
                if all(self.whole[i] for i, o in zip(where, over) if o):
                    continue  # a few words of a short item weigh much: it alone keeps the list essential
                break
            rest[where] += add
            common.add(t)
        self.blocks = -(-len(kept) // BLOCK)
        self.rest = np.array([rest[b * BLOCK : (b + 1) * BLOCK].max() for b in range(self.blocks)], np.float32)
        # per essential term its blocks and their maxima
        starts, block, most = [0], [], []
        for t in range(len(self.vocabulary)):
            best: dict[int, float] = {}
            if t not in common:
                for i, w in holders[t]:
                    best[i // BLOCK] = max(w, best.get(i // BLOCK, 0.0))
            block += best
            most += best.values()
            starts.append(len(block))
        self.starts = np.array(starts, np.int64)
        self.block = np.array(block, np.int64)
        self.most = np.array(most, np.float64)

    def survivors(self, stretch_of: np.ndarray, terms: np.ndarray, first: int, last: int) -> np.ndarray:
        """(stretch, block) pairs whose bound over this stretch and the next reaches the threshold.

        ``stretch_of`` and ``terms`` are the distinct terms by stretch, in order.
        """
        lo, hi = np.searchsorted(stretch_of, [first, last])
        t, s = terms[lo:hi], stretch_of[lo:hi] - first
        n = self.starts[t + 1] - self.starts[t]
        own = np.repeat(s, n)
        at = np.repeat(self.starts[t] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        cells = np.bincount(
            own * self.blocks + self.block[at], weights=self.most[at], minlength=(last - first) * self.blocks
        ).reshape(last - first, self.blocks)
        bound = cells + self.rest
        bound[:-1] += cells[1:]
        # the bounds add in another order than the scores
        found = np.argwhere(bound >= self.threshold - 1e-6)
        found[:, 0] += first
        return found

    def search(self, texts: list[list[bytes]]) -> Iterator[tuple[int, int, float, float, float]]:
        """Leaks: position of the text, item, score, question overlap, answer overlap."""
        if not self.ids or not texts:
            return
        get, size = self.vocabulary.get, len(self.vocabulary)
        codes, owner, base = [], [], 0
        for k, text in enumerate(texts):
            ids = np.fromiter(map(get, text, repeat(-1)), np.int64, len(text))
            codes.append(((np.arange(len(text)) // self.stretch + base) * size + ids)[ids >= 0])
            own = -(-len(text) // self.stretch)
            # an empty stretch after each text: no passage spans two texts
            owner += [(k, i * self.stretch) for i in range(own)] + [(k, own * self.stretch)]
            base += own + 1
        distinct = np.unique(np.concatenate(codes))
        stretch_of, terms = distinct // size, distinct % size
        step = max(2, CELLS // self.blocks)
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        for first in range(0, base, step):
            last = min(base, first + step + 1)  # one more: the passage's second half
            for stretch, block in self.survivors(stretch_of, terms, first, last):
                lo, hi = np.searchsorted(stretch_of, [stretch, min(stretch + 2, base)])
                has = set(terms[lo:hi].tolist())
                for i in range(block * BLOCK, min((block + 1) * BLOCK, len(self.ids))):
                    score = math.fsum(w for t, w in self.weights[i].items() if t in has)
                    if score < self.threshold:
                        continue
                    k, start = owner[stretch]
                    own = texts[k][start : start + 2 * self.stretch]
                    if self.whole[i] and self.whole[i] not in b" ".join([b"", *own, b""]):
                        continue
                    passage = set().union(*(grams(own, n) for n in {len(g) for p in self.parts[i] for g in p}))
                    question, answer = (
                        len(part & passage) / len(part) if part else 1.0 for part in self.parts[i]
                    )
                    if question >= OVERLAP and answer >= OVERLAP:
                        best[k, i] = max(best.get((k, i), (0.0, 0.0, 0.0)), (score, question, answer))
        for (k, i), found in best.items():
            yield k, i, *found


def _indexes(items: DataFrame, threshold: float) -> tuple[DataFrame, int]:
    """The pickled index of each block of distinct items, built in tasks, and the number of blocks."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [words(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([len(w) for w in own], pa.int64()),
                    pa.array([sorted(set(w)) for w in own], pa.list_(pa.binary())),
                ],
                ["item_id", "text", "length", "terms"],
            )

    known = items.distinct().mapInArrow(split, "item_id BIGINT, text STRING, length BIGINT, terms ARRAY<BINARY>")
    known = stored(known.filter("length > 0"), "items")
    number, total, longest = known.agg(F.count("*"), F.sum("length"), F.max("length")).first()
    if not number:
        return known, 0
    blocks = max(-(-number // ITEMS), -(-total // ITEM_WORDS))
    known = known.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int"))
    # a term goes to each block that has it, with the number of all items that have it
    terms = known.select("block", F.explode("terms").alias("term")).groupBy("term", "block").count()
    terms = terms.groupBy("term").agg(F.sum("count").alias("df"), F.collect_list("block").alias("blocks"))
    rows = known.select(
        "block", "item_id", "text", F.lit(None).cast("binary").alias("term"), F.lit(None).cast("bigint").alias("df")
    ).union(
        terms.select(
            F.explode("blocks").alias("block"), F.lit(None).cast("bigint"), F.lit(None).cast("string"), "term", "df"
        )
    )

    def build(table: pa.Table) -> pa.Table:
        own, df = [], {}
        for item, text, term, n in zip(*(table.column(c).to_pylist() for c in ("item_id", "text", "term", "df"))):
            if term is None:
                own.append((item, text))
            else:
                df[term] = n
        own.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        index = pickle.dumps(Index(own, threshold, Statistics(number, total / number, longest, df)))
        return pa.table({"block": table.column("block")[:1], "index": pa.array([index], pa.binary())})

    return stored(rows.groupBy("block").applyInArrow(build, "block INT, index BINARY"), "indexes"), blocks


def _search(docs: DataFrame, pickled: Broadcast) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(pickled.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                ids = part.column(0)
                found = list(own.search([words(t) for t in part.column(1).to_pylist()]))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array([f[0] for f in found], pa.int64())),
                        pa.array([own.ids[f[1]] for f in found], pa.int64()),
                        *(pa.array([f[c] for f in found], pa.float64()) for c in (2, 3, 4)),
                    ],
                    ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, _found_schema(docs))


def _found_schema(docs: DataFrame) -> str:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return f"doc_id {kind}, item_id BIGINT, score DOUBLE, question_overlap DOUBLE, answer_overlap DOUBLE"


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document and item that leaked into it: doc_id, item_id, score, question_overlap, answer_overlap."""
    spark = docs.sparkSession
    indexes, blocks = _indexes(items.select(F.col("item_id").cast("bigint").alias("item_id"), "text"), threshold)
    found = spark.createDataFrame([], _found_schema(docs))
    for k in range(blocks):
        row = indexes.filter(F.col("block") == k).select("index").first()
        if row is None:
            continue  # no item fell into it
        pickled = spark.sparkContext.broadcast(bytes(row["index"]))
        rows = _search(docs, pickled)
        if blocks == 1:
            return rows
        found = found.unionByName(stored(rows, "found"))
        pickled.destroy()
    return found


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` into which no item leaked."""
    leak_id = free_name(docs, "_leak_id")
    found = stored(leaks(docs, items).select(F.col("doc_id").alias(leak_id)).distinct(), "leaks")
    return docs.join(small_side(found), docs["doc_id"].eqNullSafe(F.col(leak_id)), "left_anti")
