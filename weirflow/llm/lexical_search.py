"""Ranked lexical search, reversed: items are indexed and documents stream through the index.

An inverted index of the items' terms is broadcast. Every document's term counts are looked
up in it, which gives the document's scores for all items that share a term with it, and each
task keeps one bounded heap per item. The heaps of all tasks, at most ``top`` rows for each
item and task, are merged by a ranking window. Corpus statistics (documents, terms, the
documents that hold a term) are those of all documents; texts are cut into terms once.

Items are indexed in blocks of about ``POSTINGS`` pairs of a term and an item, counted first, so
that what is broadcast is bounded however many items there are; each block reads the documents
once. The result does not depend on the blocks.

Terms are runs of ASCII letters, digits and all other characters beyond ASCII; only A-Z are
lower-cased. All but a term's weight is 64-bit integer arithmetic; see :func:`weight`, :func:`value`.

Defined results: a null or empty text, or one without terms, scores nothing and does not count
as a document; an item without terms has no rows; every item row is ranked for itself, also if
its ``item_id`` is null or repeated; repeated document rows are documents of their own; of equal
scores the smaller ``doc_id`` comes first, a null one last; without items or documents the
result is empty; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import stored

TOP = 20
POSTINGS = 500_000  # of a block of items
PIECE = 1 << 20  # bytes of a text that are cut into terms at once
NO_ID = 1 << 63  # stands for a missing id: after all others

_MARKS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in lists of bounded size."""
    plain = (text or b"").lower().translate(_MARKS)  # of bytes: A-Z only
    start = 0
    while start < len(plain):
        end = plain.find(b" ", start + PIECE)
        end = len(plain) if end < 0 else end
        yield plain[start:end].split()
        start = end


def weight(documents: int, holders: int) -> int:
    """Of a term that ``holders`` of all documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


def value(tf: np.ndarray, n: int, documents: int, total: int) -> np.ndarray:
    """A term's share of its weight in a document of ``n`` terms that has it ``tf`` times."""
    m = 100 - 25 + (25 * n * documents) // total
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


@dataclass
class Index:
    """Postings of a block of items: per term its weight, its items and how often each repeats it."""

    items: list[int | None]
    rows: list[int]
    vocabulary: dict[bytes, int]
    starts: np.ndarray
    holders: np.ndarray
    repeats: np.ndarray
    weights: np.ndarray | None = None
    documents: int = 0
    total: int = 0

    @classmethod
    def of(cls, items: list[tuple[int, int | None, list[bytes], list[int]]]) -> Index:
        vocabulary: dict[bytes, int] = {}
        codes, holders, repeats = [], [], []
        for k, (_, _, own, counts) in enumerate(items):
            codes += [vocabulary.setdefault(t, len(vocabulary)) for t in own]
            holders += [k] * len(own)
            repeats += counts
        order = np.argsort(np.array(codes, np.int64), kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(np.array(codes, np.int64), minlength=len(vocabulary)))])
        return cls(
            [i for _, i, _, _ in items], [r for r, _, _, _ in items], vocabulary, starts.astype(np.int64),
            np.array(holders, np.int64)[order], np.array(repeats, np.int64)[order],
        )

    def scores(self, codes: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
        """A document's score for every item."""
        each = self.weights[codes] * value(counts, n, self.documents, self.total)
        lengths = self.starts[codes + 1] - self.starts[codes]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[codes] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        scores = np.zeros(len(self.items), np.int64)
        np.add.at(scores, self.holders[at], np.repeat(each, lengths) * self.repeats[at])
        return scores


class Heaps:
    """The best documents of each item, at most ``top``."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(items)]
        self.floors = np.ones(items, np.int64)  # below which a score changes nothing

    def offer(self, scores: np.ndarray, doc_id: int | None) -> None:
        key = -(NO_ID if doc_id is None else doc_id)
        for k in np.flatnonzero(scores >= self.floors).tolist():
            heap, entry = self.heaps[k], (int(scores[k]), key)
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.top:
                self.floors[k] = heap[0][0]


def _counted(rows: DataFrame, known: Broadcast | None = None) -> DataFrame:
    """Per row: its id, its number of terms, and its distinct terms with their counts.

    With a vocabulary only the terms it has, as codes; a row without terms is left out.
    """
    name = rows.columns[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = None if known is None else known.value
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                ids, sizes, own, counts = [], [], [], []
                texts = part.column(1).cast(pa.binary()).to_pylist()
                for key, text in zip(part.column(0).to_pylist(), texts):
                    n, found = 0, Counter()
                    for some in terms(text):
                        n += len(some)
                        found.update(some if codes is None else (c for c in map(codes.get, some) if c is not None))
                    if n:
                        ids.append(key)
                        sizes.append(n)
                        own.append(list(found))
                        counts.append(list(found.values()))
                kind = pa.binary() if codes is None else pa.int32()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                        pa.array(own, pa.list_(kind)), pa.array(counts, pa.list_(pa.int64())),
                    ],
                    [name, "n", "terms", "counts"],
                )

    kind = "BINARY" if known is None else "INT"
    return rows.mapInArrow(run, f"{name} BIGINT, n BIGINT, terms ARRAY<{kind}>, counts ARRAY<BIGINT>")


def _best(counted: DataFrame, index: Broadcast, top: int) -> DataFrame:
    """The heaps of every task as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        heaps = Heaps(len(own.items), top)
        for batch in batches:
            ids, sizes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k, (key, n) in enumerate(zip(ids, sizes)):
                codes = np.asarray(batch.column(2)[k].values, np.int64)
                counts = np.asarray(batch.column(3)[k].values, np.int64)
                heaps.offer(own.scores(codes, counts, n), key)
        for k, heap in enumerate(heaps.heaps):
            if heap:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([own.rows[k]] * len(heap), pa.int64()),
                        pa.array([own.items[k]] * len(heap), pa.int64()),
                        pa.array([None if -i == NO_ID else -i for _, i in heap], pa.int64()),
                        pa.array([s for s, _ in heap], pa.int64()),
                    ],
                    ["item_row", "item_id", "doc_id", "score"],
                )

    return counted.filter(F.size("terms") > 0).mapInArrow(
        run, "item_row BIGINT, item_id BIGINT, doc_id BIGINT, score BIGINT"
    )


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """Per item its ``top`` best documents: item_id, rank from 1, doc_id, score."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    wanted = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    wanted = stored(_counted(wanted).withColumn("item_row", F.monotonically_increasing_id()), "items")
    postings = wanted.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-postings // POSTINGS)
    wanted = wanted.withColumn("block", F.pmod(F.xxhash64("item_row"), F.lit(max(blocks, 1))))
    found = spark.createDataFrame([], "item_row BIGINT, item_id BIGINT, doc_id BIGINT, score BIGINT")
    for block in range(blocks):
        rows = wanted.filter(F.col("block") == block).select("item_row", "item_id", "terms", "counts")
        index = Index.of([(r[0], r[1], [bytes(t) for t in r[2]], r[3]) for r in rows.collect()])  # one block
        if not index.items:
            continue
        vocabulary = spark.sparkContext.broadcast(index.vocabulary)
        counted = stored(_counted(texts, vocabulary), "term-counts")
        vocabulary.unpersist()
        index.documents, total = counted.agg(F.count("*"), F.sum("n")).first()
        index.total = total or 1
        holders = np.zeros(len(index.vocabulary), np.int64)
        for term, df in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            holders[term] = df  # terms of the block only
        index.weights = np.array([weight(index.documents, int(df)) for df in holders], np.int64)
        index.vocabulary = {}
        found = found.unionByName(stored(_best(counted, spark.sparkContext.broadcast(index), top), "heaps"))
    order = Window.partitionBy("item_row").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select("item_id", "rank", "doc_id", "score")
    )
