"""SentencePiece encoding and decoding for merge-type vocabularies.

The encoder keeps an agenda of adjacent symbol pairs and always merges the pair whose
piece scores highest, leftmost first, until no pair forms a piece; symbols that are no
piece become bytes. A text is cut into units between any two characters that stand side by side
in no piece, so that no merge reaches beyond its unit. The different units of a batch of texts are
merged side by side, one pair of each at a time: their agendas are rows of a matrix, and
merging a pair looks up only the two pairs next to it. Nothing is kept from batch to batch.
The ids of each whole text are compared with the sentencepiece library; a difference stops
the job. Ids are decoded by the library.

Defined results: a null or empty text has no pieces and decodes to the empty text;
rows are independent, so repeated rows and other columns change nothing; ``doc_id``
may be null.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
ROWS, CHARS = 500, 1 << 20  # of a batch
WIDTHS = (8, 16, 32, 64)  # symbols of the units that are merged side by side; longer ones one by one
CODE_POINTS = 0x110000
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Codec:
    """Encoder and decoder of one model file.

    Symbols are numbers: a piece's id, or for a character that is no piece the number of
    pieces plus its code point.
    """

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=model)
        size = self.size = self.library.get_piece_size()
        self.pieces = [self.library.id_to_piece(i) for i in range(size)]
        self.unknown = self.library.unk_id()
        self.bytes = {}
        self.scores, self.ids = {}, {}
        for i, piece in enumerate(self.pieces):
            if self.library.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not self.library.is_control(i) and not self.library.is_unknown(i):
                self.scores[piece] = self.library.get_score(i)
                self.ids[piece] = i
        self.symbol = np.arange(size, size + CODE_POINTS, dtype=np.int64)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        self.symbol[ord(" ")] = self.symbol[ord(SPACE)]  # spaces are read as marks
        # higher scores have higher ranks, equal ones the same
        levels = {s: k for k, s in enumerate(sorted(set(self.scores.values())))}
        self.rank = np.full(size + 1, -1, np.int32)  # the last is that of no piece
        for piece, i in self.ids.items():
            self.rank[i] = levels[self.scores[piece]]
        self._index_pairs()
        self._index_neighbours()
        self.texts = np.array([b"%d," % i for i in range(size)])
        self.lengths = np.char.str_len(self.texts).astype(np.int64)

    def _index_pairs(self) -> None:
        """A hash table from pairs of symbols to the piece that they form."""
        found = {}
        for piece, i in self.ids.items():
            for k in range(1, len(piece)):
                a, b = self._number(piece[:k]), self._number(piece[k:])
                if a is not None and b is not None:
                    found[a * (self.size + CODE_POINTS) + b] = i
        bits = max(4, (4 * len(found)).bit_length())
        self.shift, slots = np.uint64(64 - bits), 1 << bits
        self.keys, self.values = np.full(slots + 64, -1, np.int64), np.full(slots + 64, self.size, np.int32)
        keys = np.array(list(found), np.int64)
        values = np.array(list(found.values()), np.int32)
        home = ((keys.astype(np.uint64) * _SPREAD) >> self.shift).astype(np.int64)
        self.probes, left = 0, np.arange(len(keys))
        while len(left):  # each takes its slot, or that after it, and so on
            slot = home[left] + self.probes
            free = self.keys[slot] < 0
            _, first = np.unique(slot, return_index=True)
            taken = np.zeros(len(left), bool)
            taken[first] = True
            taken &= free
            self.keys[slot[taken]], self.values[slot[taken]] = keys[left[taken]], values[left[taken]]
            left = left[~taken]
            self.probes += 1

    def _number(self, text: str) -> int | None:
        return self.ids.get(text, self.size + ord(text) if len(text) == 1 else None)

    def _index_neighbours(self) -> None:
        """Which characters stand side by side in a piece."""
        pairs = {(x, y) for piece in self.ids for x, y in zip(piece, piece[1:])}
        letters = sorted({c for pair in pairs for c in pair})
        self.group = np.zeros(CODE_POINTS, np.int32)  # of characters in no pair: 0
        for k, c in enumerate(letters, 1):
            self.group[ord(c)] = k
        self.group[ord(" ")] = self.group[ord(SPACE)]
        self.groups = len(letters) + 1
        self.joined = np.zeros(self.groups * self.groups, bool)
        for x, y in pairs:
            self.joined[self.group[ord(x)] * self.groups + self.group[ord(y)]] = True

    def pieces_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols forms; the number of pieces if none."""
        key = a * (self.size + CODE_POINTS) + b
        slot = ((key.astype(np.uint64) * _SPREAD) >> self.shift).astype(np.int64)
        out = np.full(len(key), self.size, np.int32)
        open_ = np.arange(len(key))
        for _ in range(self.probes):
            there = self.keys[slot]
            hit = there == key
            out[open_[hit]] = self.values[slot[hit]]
            more = ~hit & (there >= 0)
            if not more.any():
                break
            key, slot, open_ = key[more], slot[more] + 1, open_[more]
        return out

    def merge_all(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of some units after all merges, one unit after the other, and their numbers."""
        starts = np.cumsum(sizes) - sizes
        left = sizes.copy()
        rows_out, where_out = [], []
        low = 1
        for width in WIDTHS:
            rows = np.flatnonzero((sizes > low) & (sizes <= width))
            if len(rows):
                self._merge_matrix(rows, symbols, starts, sizes, width, left, rows_out, where_out)
            low = width
        single = np.flatnonzero(sizes == 1)
        rows_out.append(symbols[starts[single]])
        where_out.append(single)
        for k in np.flatnonzero(sizes > WIDTHS[-1]).tolist():
            text = [self._text(x) for x in symbols[starts[k] : starts[k] + sizes[k]].tolist()]
            merged = np.array([self._number(x) for x in self._merge_long(text)], np.int64)
            left[k] = len(merged)
            rows_out.append(merged)
            where_out.append(np.full(len(merged), k))
        unit = np.concatenate(where_out)
        order = np.argsort(unit, kind="stable")
        return np.concatenate(rows_out)[order], left

    def _text(self, symbol: int) -> str:
        return self.pieces[symbol] if symbol < self.size else chr(symbol - self.size)

    def _merge_matrix(self, rows, symbols, starts, sizes, width, left, rows_out, where_out) -> None:
        columns = np.arange(width)
        inside = columns < sizes[rows][:, None]
        own = np.full((len(rows), width), -1, np.int64)
        own[inside] = symbols[(starts[rows][:, None] + columns)[inside]]
        pair = inside[:, 1:]
        formed = np.full((len(rows), width), self.size, np.int32)  # by each symbol and the next
        formed[:, :-1][pair] = self.pieces_of(own[:, :-1][pair], own[:, 1:][pair])
        agenda = self.rank[formed]
        while len(rows):
            best = agenda.argmax(axis=1)  # of equal ones the leftmost
            every = np.arange(len(rows))
            going = agenda[every, best] >= 0
            if not going.all():
                done = ~going
                some = own[done]
                kept = some >= 0
                counts = kept.sum(axis=1)
                left[rows[done]] = counts
                rows_out.append(some[kept])
                where_out.append(np.repeat(rows[done], counts))
                rows, own, formed, agenda, best = rows[going], own[going], formed[going], agenda[going], best[going]
                every = np.arange(len(rows))
                if not len(rows):
                    break
            new = formed[every, best].astype(np.int64)
            after = columns[:-1] > best[:, None]
            own[:, :-1] = np.where(after, own[:, 1:], own[:, :-1])
            formed[:, :-1] = np.where(after, formed[:, 1:], formed[:, :-1])
            own[:, -1], formed[:, -1] = -1, self.size
            own[every, best] = new
            before = np.flatnonzero(best > 0)
            formed[before, best[before] - 1] = self.pieces_of(own[before, best[before] - 1], new[before])
            formed[every, best] = self.size
            following = own[every, np.minimum(best + 1, width - 1)]
            has = np.flatnonzero((following >= 0) & (best + 1 < width))
            formed[has, best[has]] = self.pieces_of(new[has], following[has])
            agenda = self.rank[formed]

    def merge(self, unit: str) -> list[str]:
        """The symbols of a unit after all merges."""
        symbols = self.symbol[np.array([ord(c) for c in unit], np.int64)]
        merged, _ = self.merge_all(symbols, np.array([len(unit)]))
        return [self._text(x) for x in merged.tolist()]

    def _merge_long(self, symbols: list[str]) -> list[str]:
        """The same with a heap over a linked list of symbols."""
        get, n = self.scores.get, len(symbols)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and right[i] >= 0:
                joined = symbols[i] + symbols[right[i]]
                if (score := get(joined)) is not None:
                    heapq.heappush(agenda, (-score, i, joined))

        for i in range(n - 1):
            offer(i)
        while agenda:
            _, i, joined = heapq.heappop(agenda)
            j = right[i]
            # a pair whose symbols have changed since is out of date
            if not symbols[i] or j < 0 or len(symbols[i]) + len(symbols[j]) != len(joined) \
                    or symbols[i] + symbols[j] != joined:
                continue
            symbols[i], symbols[j], right[i] = joined, "", right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer(left[i])
            offer(i)
        return [s for s in symbols if s]

    def _spelled(self, symbols: np.ndarray, owner_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols, those that are no piece as bytes, and the numbers of ids of their owners."""
        odd = symbols >= self.size
        if not odd.any():
            return symbols, owner_sizes
        counts = np.ones(len(symbols), np.int64)
        spelled = {
            x: [self.bytes[b] for b in chr(x - self.size).encode("utf-8", "surrogatepass")] if self.bytes else [self.unknown]
            for x in np.unique(symbols[odd]).tolist()
        }
        at = np.flatnonzero(odd)
        counts[at] = [len(spelled[x]) for x in symbols[at].tolist()]
        out = np.repeat(symbols, counts)
        out[np.repeat(odd, counts)] = list(chain.from_iterable(spelled[x] for x in symbols[at].tolist()))
        total = np.concatenate([[0], np.cumsum(counts)])
        ends = np.cumsum(owner_sizes)
        return out, total[ends] - total[ends - owner_sizes]

    def segments(self, text: str) -> Iterator[str]:
        """A text, the mark before it included, cut after about so many characters where a unit ends."""
        text = SPACE + text.replace(" ", SPACE)
        start = 0
        while start < len(text):
            end = min(start + CHARS, len(text))
            while end < len(text) and self.joined[
                self.group[ord(text[end - 1])] * self.groups + self.group[ord(text[end])]
            ]:
                end += 1
            yield text[start:end]
            start = end

    def encode(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some segments, one after the other, and their numbers."""
        codes = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(x) for x in segments])
        group = self.group[codes]
        cut = np.empty(len(codes), bool)
        cut[0] = True
        cut[1:] = ~self.joined[group[:-1] * self.groups + group[1:]]
        cut[ends[:-1]] = True
        starts = np.flatnonzero(cut)
        sizes = np.diff(np.append(starts, len(codes)))
        # equal units have equal hashes; texts are compared whole, so that no collision goes unseen
        symbols = self.symbol[codes]
        place = np.arange(len(codes)) - np.repeat(starts, sizes)
        hashed = _mixed(symbols.astype(np.uint64) * _SPREAD + _mixed_places(place))
        hashed = np.add.reduceat(hashed, starts)
        _, first, which = np.unique(hashed, return_index=True, return_inverse=True)
        own = sizes[first]
        merged, left = self.merge_all(symbols[_spans(starts[first], own)], own)
        merged, left = self._spelled(merged, left)
        offsets = np.cumsum(left) - left
        counts = left[which]
        ids = merged[_spans(offsets[which], counts)]
        total = np.concatenate([[0], np.cumsum(counts)])
        # units of each text
        last = np.searchsorted(starts, ends)
        return ids, np.diff(total[np.concatenate([[0], last])])

    def process(self, texts: list[str | None]) -> list[tuple[list[int], bytes, str]]:
        """Per text: its ids, the ids as text joined by commas, the decoded text."""
        out: list[tuple[list[int], bytes, str]] = []
        for some in _batches(texts):
            theirs = self.library.encode(some, num_threads=1)
            sizes = np.array([len(x) for x in theirs], np.int64)
            flat = np.fromiter(chain.from_iterable(theirs), np.int64, sizes.sum())
            owner, pieces = [], []
            for k, text in enumerate(some):
                for piece in self.segments(text) if text else ():
                    owner.append(k)
                    pieces.append(piece)
            encoded = [self.encode(x) for x in _batches(pieces)]
            own = np.concatenate([flat[:0], *(ids for ids, _ in encoded)])
            counts = np.bincount(
                np.array(owner, np.int64), weights=np.concatenate([sizes[:0], *(n for _, n in encoded)]), minlength=len(some)
            )
            if not np.array_equal(own, flat) or not np.array_equal(counts, sizes):
                raise ValueError(f"the ids of {some[0][:200]!r} or of a text after it differ from those of the library")
            joined = self.texts[flat].tobytes().translate(None, b"\0")
            total = np.concatenate([[0], np.cumsum(self.lengths[flat])])
            ends = np.cumsum(sizes)
            spans = zip(total[ends - sizes].tolist(), total[ends].tolist())
            decoded = self.library.decode(theirs, num_threads=1)
            out += [(ids, joined[a : max(a, b - 1)], text) for ids, (a, b), text in zip(theirs, spans, decoded)]
        return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _mixed_places(place: np.ndarray) -> np.ndarray:
    return (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of some spans."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _batches(texts: list[str | None]) -> Iterator[list[str]]:
    some: list[str] = []
    size = 0
    for text in texts:
        some.append(text or "")
        size += len(text or "")
        if len(some) >= ROWS or size >= CHARS:
            yield some
            some, size = [], 0
    if some:
        yield some


@lru_cache(maxsize=2)
def codec(model: str) -> Codec:
    """One codec per worker process and model file."""
    return Codec(model)


def digests(docs: DataFrame, model: str) -> DataFrame:
    """Per row: doc_id, number of ids, and the hashes of the ids and of the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                rows = own.process(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(ids) for ids, _, _ in rows], pa.int64()),
                        pa.array([hashlib.sha256(ids).hexdigest() for _, ids, _ in rows], pa.string()),
                        pa.array([hashlib.sha256(text.encode()).hexdigest() for _, _, text in rows], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING"
    )


def encode(docs: DataFrame, model: str) -> DataFrame:
    """Per row: doc_id and the ids of its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                ids = [ids for ids, _, _ in own.process(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids ARRAY<INT>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Per row of ``encode``: doc_id and the text its ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            texts = [own.library.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text STRING")
