"""Sharding by histogram sort (native).

Rows are ordered by a key: a hash of their text, then their id, so equal texts stand
together. The splitters between shards are found without sorting. Each unresolved
splitter has a cell of keys in which it lies, at first the whole key space; a round
probes ``2 ** DIGIT`` boundaries in every such cell, counts the exact bytes between them
in one pass over (size, key), and keeps the part in which the wanted byte count falls.
Cells of hashes are divided first, then, for a text that many rows share, cells of ids.
A splitter is done when a boundary of its part meets the tolerance or the part is one
row or one key. Then all rows are exchanged once.

The driver holds only the counts of the parts of unresolved cells, at most ``2 ** DIGIT``
per shard. The exchange goes by shard and a hash of the id, so that many tasks number a
shard; each starts at the number of rows of the shard's earlier parts.

Defined results: a null text has no bytes and the crc32 of no bytes; rows equal in text
and id, as repeated rows are, stay in one shard; null ids come first; an empty table has
no rows; other columns are ignored. Bytes of shards differ by the tolerance and the
size of single rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import shuffle_width, stored

OVERHEAD = 16  # bytes a row counts besides its text
DIGIT = 10  # bits of a key that one round resolves
TOLERANCE = 0.001  # of a shard's share of all bytes
HASH_BITS, ID_BITS = 60, 63
SIGN = -(1 << 63)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the key (h, i), neither negative."""
    text = F.coalesce("text", F.lit(""))
    number = F.col("doc_id").cast("bigint").bitwiseXOR(F.lit(SIGN))  # unsigned order
    return docs.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 64 - HASH_BITS).alias("h"),
        F.coalesce(F.shiftrightunsigned(number, 64 - ID_BITS), F.lit(0)).cast("bigint").alias("i"),
    )


@dataclass
class Search:
    """A splitter in search: its wanted bytes, and the cell of keys it lies in."""

    wanted: float
    below: int = 0  # exact bytes of all keys before the cell
    owner: int | None = None  # the hash whose ids are being divided
    prefix: int = 0
    depth: int = 0
    found: tuple[int, int] | None = None

    @property
    def bits(self) -> int:
        return HASH_BITS if self.owner is None else ID_BITS

    @property
    def cell(self) -> tuple[int | None, int, int]:
        return self.owner, self.prefix, self.depth

    def key(self, part: int, depth: int) -> tuple[int, int]:
        """The first key of a part at a depth."""
        first = part << (self.bits - depth)
        return (first, 0) if self.owner is None else (self.owner, first)

    def refine(self, counts: list[tuple[int, int, int]], tolerance: float) -> None:
        """Narrow the cell by the (part, bytes, rows) of its parts, in order."""
        depth = min(self.depth + DIGIT, self.bits)
        for part, size, rows in counts:
            if self.below + size <= self.wanted:
                self.below += size
                continue
            before, after = self.wanted - self.below, self.below + size - self.wanted
            last = rows == 1 or (depth == self.bits and self.owner is not None)
            if min(before, after) <= tolerance or last:
                self.found = self.key(part if before <= after else part + 1, depth)
            elif depth == self.bits:
                self.owner, self.prefix, self.depth = part, 0, 0
            else:
                self.prefix, self.depth = part, depth
            return
        self.found = self.key(((self.prefix + 1) << (depth - self.depth)), depth)


def _count(rows: DataFrame, cells: set[tuple[int | None, int, int]]) -> dict:
    """Exact (part, bytes, rows) of the parts of each cell, by one pass for each depth."""
    found: dict = {cell: [] for cell in cells}
    for by_id, depth in sorted({(owner is not None, depth) for owner, _, depth in cells}):
        own = [c for c in cells if (c[0] is not None) == by_id and c[2] == depth]
        column, bits = ("i", ID_BITS) if by_id else ("h", HASH_BITS)
        shift = bits - min(depth + DIGIT, bits)
        prefix = F.shiftright(column, bits - depth) if depth else F.lit(0).cast("bigint")
        inside = F.struct(F.col("h") if by_id else F.lit(-1).cast("bigint"), prefix)
        wanted = [F.struct(F.lit(-1 if o is None else o).cast("bigint"), F.lit(p).cast("bigint")) for o, p, _ in own]
        groups = ["owner", "prefix", "part"]
        counts = (
            rows.filter(inside.isin(*wanted))
            .select(
                (F.col("h") if by_id else F.lit(-1).cast("bigint")).alias("owner"),
                prefix.alias("prefix"), F.shiftright(column, shift).alias("part"), "size",
            )
            .groupBy(*groups).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        )
        for r in counts.collect():
            cell = (r["owner"] if by_id else None, r["prefix"], depth)
            found[cell].append((r["part"], r["bytes"], r["rows"]))
    return {cell: sorted(parts) for cell, parts in found.items()}


def splitters(rows: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """The first keys of shards 1 to shards - 1, in order; rows have size, h and i."""
    total = rows.agg(F.sum("size").alias("bytes")).first()["bytes"] or 0
    searches = [Search(total * k / shards) for k in range(1, shards)]
    while open_ones := [s for s in searches if s.found is None]:
        counts = _count(rows, {s.cell for s in open_ones})
        for s in open_ones:
            s.refine(counts[s.cell], tolerance * total / shards)
    return sorted(s.found for s in searches)


def shard_of(keys: list[tuple[int, int]]) -> Column:
    """The number of splitters at or before the key of a row."""
    h, i = F.col("h"), F.col("i")
    out = F.lit(0)
    for first, second in keys:
        out = out + ((h > first) | ((h == first) & (i >= second))).cast("int")
    return out


def shard(docs: DataFrame, shards: int) -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard and slot."""
    rows = stored(keyed(docs), "shard-keys")
    parts = max(1, -(-2 * shuffle_width(docs.sparkSession) // shards))
    placed = rows.select(
        "doc_id", "size", "text_crc32", "h", "i",
        shard_of(splitters(rows, shards)).alias("shard"),
        F.pmod(F.xxhash64("doc_id", "h"), F.lit(parts)).cast("int").alias("part"),
    )
    sizes = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))  # shards times parts rows at most
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("shard").alias("of_shard"), F.col("part").alias("of_part"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
    )
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("h", "i", "doc_id"))
    numbered = placed.withColumn("place", place - 1)
    return numbered.join(
        F.broadcast(starts), (F.col("shard") == F.col("of_shard")) & (F.col("part") == F.col("of_part"))
    ).select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("place")).cast("bigint").alias("slot"))
