"""Spelling variants: words that differ by one code point, found by search schemes on FM-indexes.

The vocabulary is laid out as one delimited text. A word within one inserted, deleted or replaced
code point of another has one half of it unchanged, at its beginning or at its end. So two
searches find all such words: one matches the first half exactly, with the delimiter before it,
and then extends to the right over the other half with one error and the closing delimiter; the
other is its mirror image. Both work on intervals of suffix ranks. The exact half narrows the
interval in the text's index and, by the number of smaller characters before it, that in the
index of the reversed text, from which the extension then goes on in the other direction.

The vocabulary is cut into blocks of about ``BLOCK`` words, each with an index of its own. An exact
half fixes a word's first or last three code points (of five-letter words the first two), so
a block holds all words that share such pieces and a word is searched only where a near word
can be. Many pieces share a block; a piece with more words than a block has is cut into parts,
and each part is searched for the words of each.

A word's form is its most frequent near word if that is twice as frequent or more; forms are
followed to the last by repeatedly replacing each word's form by that of its form. The number
of occurrences at least doubles with each step, so a few rounds reach the end.

Words are runs of ``A-Za-z`` and U+00C0 to U+00FF; only A-Z are lower-cased. A known share of the
runs loses a letter before they are counted, see :func:`misspelt`.

Defined results: null, empty and wordless texts give no words; rows without ``doc_id`` lose no
letters; repeated rows count each; of near words that are equally frequent the smallest in
code-point order is the form; a word without form is its own root; without words the result
is empty; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import shuffle_width, stored

LETTERS, OCCURRENCES = 5, 3  # the least of a word
LOSES = 97  # one in so many different runs of a document loses a letter
RATIO = 2  # how much more frequent a form is
BLOCK = 20_000  # words of an index
KEPT = 200_000  # counts a task holds before it passes them on
STEP = 32  # characters between two stored rows of counts
QUERIES = 4096  # words searched together
PIECE = 1 << 20  # characters of a text that are split at once

#: Latin-1 bytes, in which each code point is one byte: A-Z in lower case, all but letters as spaces.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


# ---- counting ----


def runs(text: str | None) -> Iterator[list[bytes]]:
    """The runs of letters of a text, as Latin-1, in lists of bounded size."""
    plain = (text or "").encode("latin-1", "replace").translate(_LETTERS)
    start = 0
    while start < len(plain):
        end = plain.find(b" ", start + PIECE)
        end = len(plain) if end < 0 else end
        yield plain[start:end].split()
        start = end


def misspelt(run: bytes, before: int) -> bytes:
    """The run, without one letter if 97 divides the crc32 of the document's id and the run.

    ``before`` is the crc32 of the id and a colon.
    """
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), before)
    if h % LOSES:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def vocabulary(docs: DataFrame) -> DataFrame:
    """The words of enough letters and occurrences: word, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: Counter = Counter()

        def passed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in kept], pa.string()), pa.array(list(kept.values()), pa.int64())],
                ["word", "n"],
            )
            kept.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                own: Counter = Counter()
                for some in runs(text.as_py()):
                    own.update(some)
                before = None if (i := doc_id.as_py()) is None else zlib.crc32(b"%d:" % i)
                for word, n in own.items():
                    if len(word) < LETTERS:
                        continue
                    if before is not None:
                        word = misspelt(word, before)
                        if len(word) < LETTERS:
                            continue
                    kept[word] += n
                if len(kept) >= KEPT:
                    yield passed()
        if kept:
            yield passed()

    counted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "word STRING, n BIGINT")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= OCCURRENCES)


# ---- the index ----


class FMIndex:
    """Suffix ranks of a text of small integers: which interval of them a longer pattern has."""

    def __init__(self, text: np.ndarray, letters: int):
        n = len(text)
        self.ranks = _suffix_array(text, letters)
        last = text[self.ranks - 1].astype(np.uint8)  # the character before each suffix
        rows = -(-n // STEP)
        padded = np.full((rows + 1) * STEP, 255, np.uint8)
        padded[:n] = last
        self.last = padded.reshape(-1, STEP)
        counts = np.zeros((rows + 2, letters), np.int32)
        np.add.at(counts, (np.arange(n) // STEP + 1, last), 1)
        self.counts = np.cumsum(counts, axis=0, dtype=np.int32)
        #: how many smaller characters there are up to each stored row
        self.smaller = np.cumsum(self.counts, axis=1, dtype=np.int32) - self.counts
        total = self.counts[-1].astype(np.int64)
        self.first = np.cumsum(total) - total
        self.letters = letters

    def _at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row = places // STEP
        return row, self.last[row], np.arange(STEP) < (places % STEP)[:, None]

    def before(self, places: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often ``c``, and a smaller character, stands before a rank."""
        row, some, inside = self._at(places)
        c_ = c[:, None]
        return (
            self.counts[row, c] + ((some == c_) & inside).sum(axis=1),
            self.smaller[row, c] + ((some < c_) & inside).sum(axis=1),
        )

    def each_before(self, places: np.ndarray) -> np.ndarray:
        """How often each character stands before a rank."""
        row, some, inside = self._at(places)
        at, _ = np.nonzero(inside)
        extra = np.bincount(at * self.letters + some[inside], minlength=len(places) * self.letters)
        return self.counts[row] + extra.reshape(-1, self.letters)

    def extended(self, low: np.ndarray, high: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The intervals with ``c`` before the pattern, and how many smaller characters stand there."""
        (a, a_less), (b, b_less) = self.before(low, c), self.before(high, c)
        return self.first[c] + a, self.first[c] + b, b_less - a_less

    def children(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All intervals that are not empty with one more letter before: owner, letter, low, high."""
        a, b = self.each_before(low), self.each_before(high)
        owner, c = np.nonzero(b > a)
        real = c > 0  # no delimiter
        owner, c = owner[real], c[real]
        return owner, c, self.first[c] + a[owner, c], self.first[c] + b[owner, c]


def _suffix_array(text: np.ndarray, letters: int) -> np.ndarray:
    """The starts of all suffixes in order, by doubling the compared length."""
    n, bits = len(text), max(1, int(letters).bit_length())
    width = min(62 // bits, 8)
    key = np.zeros(n, np.int64)
    for k in range(width):
        key <<= bits
        key[: n - k] += text[k:] + 1  # beyond the end: smaller than any
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if rank[order[-1]] == n - 1:
            return order
        key = rank * (n + 1)
        key[: n - width] += rank[width:] + 1
        width *= 2


class Variants:
    """The index of some words in both directions."""

    def __init__(self, words: list[bytes]):
        self.words = words
        joined = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", np.uint8)
        self.codes = np.zeros(256, np.int64)
        used = np.unique(joined)  # the delimiter is 0
        self.codes[:] = -1
        self.codes[used] = np.arange(len(used))
        text = self.codes[joined]
        self.indexes = FMIndex(text, len(used)), FMIndex(text[::-1], len(used))
        delimiters = np.flatnonzero(text == 0)
        self.delimiters = delimiters, len(text) - 1 - delimiters[::-1]

    def near(self, asked: list[bytes], sides: tuple[bool, ...] = (True, True)) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(position in ``asked``, position in the index) of words that are one error apart.

        ``sides``: whether the first half, and the last half, is matched exactly. A pair may
        come more than once.
        """
        lengths = np.array([len(w) for w in asked])
        for length in np.unique(lengths).tolist():
            every = np.flatnonzero(lengths == length)
            for start in range(0, len(every), QUERIES):
                own = every[start : start + QUERIES]
                block = self.codes[np.frombuffer(b"".join(asked[k] for k in own), np.uint8).reshape(-1, length)]
                half = length // 2
                if sides[0]:
                    owner, found = self._search(block, half, *self.indexes)
                    # the end of the search stands in the reversed text, before the word
                    yield own[owner], len(self.words) - 1 - np.searchsorted(self.delimiters[1], found)
                if sides[1]:
                    owner, found = self._search(block[:, ::-1], length - half, *self.indexes[::-1])
                    yield own[owner], np.searchsorted(self.delimiters[0], found)

    def _search(self, block: np.ndarray, half: int, text: FMIndex, mirror: FMIndex) -> tuple[np.ndarray, np.ndarray]:
        """The first ``half`` letters exactly, one error in the others: owner, place of its delimiter in the mirror."""
        count, length = block.shape
        # letters that the index lacks can only be where the error is
        owner = np.flatnonzero((block[:, :half] >= 0).all(axis=1))
        size = len(text.ranks)
        low, high = np.zeros(len(owner), np.int64), np.full(len(owner), size, np.int64)
        low_m = low.copy()
        for k in range(half - 1, -2, -1):
            c = block[owner, k] if k >= 0 else np.zeros(len(owner), np.int64)
            low, high, less = text.extended(low, high, c)
            low_m = low_m + less
            keep = high > low
            owner, low, high, low_m = owner[keep], low[keep], high[keep], low_m[keep]
        low, high = low_m, low_m + high - low
        # from here on in the mirror: states without an error, and those with one
        wrong = tuple(np.empty(0, np.int64) for _ in range(3))
        for k in range(half, length + 1):
            expected = block[:, k] if k < length else np.zeros(count, np.int64)
            mine, c, child_low, child_high = mirror.children(low, high)
            mine = owner[mine]
            # one letter more than the word has: not the expected one, which may come later instead
            other = c != expected[mine]
            more = mine[other], child_low[other], child_high[other]
            wrong = tuple(np.concatenate(x) for x in zip(wrong, more))
            wrong = self._step(mirror, *wrong, expected)
            if k < length:
                wrong = tuple(np.concatenate(x) for x in zip(wrong, more, (owner, low, high)))  # replaced, left out
                owner, low, high = self._step(mirror, owner, low, high, expected)
        return np.repeat(wrong[0], wrong[2] - wrong[1]), mirror.ranks[_spans(wrong[1], wrong[2])]

    @staticmethod
    def _step(mirror: FMIndex, owner: np.ndarray, low: np.ndarray, high: np.ndarray, expected: np.ndarray):
        keep = expected[owner] >= 0
        owner, low, high = owner[keep], low[keep], high[keep]
        low, high, _ = mirror.extended(low, high, expected[owner])
        keep = high > low
        return owner[keep], low[keep], high[keep]


def _spans(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers of some intervals."""
    sizes = high - low
    ends = np.cumsum(sizes)
    return np.repeat(low - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


# ---- on Spark ----


def _entries(words: DataFrame) -> DataFrame:
    """Per block, side and word: whether it is indexed and whether it is asked for."""
    size = F.char_length("word")

    def entry(side: int, piece, indexed, asked):
        return F.struct(
            F.lit(side).alias("side"), piece.alias("piece"), indexed.alias("indexed"), asked.alias("asked")
        )

    yes = F.lit(True)
    # of a word the first half, rounded down, is two letters for five, else three or more; the last at least three
    all_of = F.array(
        entry(0, F.substring("word", 1, 3), yes, size >= 6),
        entry(0, F.substring("word", 1, 2), size <= 6, size == 5),
        entry(1, F.expr("right(word, 3)"), yes, yes),
    )
    spread = words.select("word", "n", F.explode(all_of).alias("e")).select("word", "n", "e.*").filter("indexed OR asked")
    sizes = stored(spread.groupBy("side", "piece").count(), "pieces")  # at most as many as there are three letters
    total = sizes.agg(F.sum("count")).first()[0] or 0
    buckets = max(1, -(-total // BLOCK))
    large = sizes.filter(F.col("count") > BLOCK).select(
        "side", "piece", F.ceil(F.col("count") / BLOCK).cast("int").alias("parts")
    )  # at most one for each block
    marked = spread.join(F.broadcast(large), ["side", "piece"], "left")
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    small = marked.filter("parts IS NULL").select(
        F.concat_ws(" ", "side", F.pmod(F.xxhash64("side", "piece"), F.lit(buckets))).alias("block"),
        "side", "word", "n", "indexed", "asked",
    )
    hot = marked.filter("parts IS NOT NULL").withColumn("part", own)
    name = F.concat_ws(" ", "side", "piece", F.col("i"), F.col("j"))
    indexed = hot.filter("indexed").select("*", F.col("part").alias("i"), F.explode(others).alias("j")).select(
        name.alias("block"), "side", "word", "n", F.lit(True).alias("indexed"), F.lit(False).alias("asked")
    )
    asked = hot.filter("asked").select("*", F.explode(others).alias("i"), F.col("part").alias("j")).select(
        name.alias("block"), "side", "word", "n", F.lit(False).alias("indexed"), F.lit(True).alias("asked")
    )
    return small.unionByName(indexed).unionByName(asked)


def near_pairs(words: DataFrame) -> DataFrame:
    """Per word and near word: word, near, near_n. ``words``: word, n, each word once."""

    def search(table: pa.Table) -> pa.Table:
        side = table.column("side")[0].as_py()
        rows = zip(*(table.column(c).to_pylist() for c in ("word", "n", "indexed", "asked")))
        # a word may stand in a block for two pieces
        known: dict[bytes, int] = {}
        asked: set[bytes] = set()
        for word, n, is_indexed, is_asked in rows:
            word = word.encode("latin-1")
            if is_indexed:
                known[word] = n
            if is_asked:
                asked.add(word)
        out: set[tuple[bytes, bytes]] = set()
        if known and asked:
            index, queries = Variants(sorted(known)), sorted(asked)
            for a, b in index.near(queries, (side == 0, side == 1)):
                out.update((queries[i], index.words[j]) for i, j in zip(a.tolist(), b.tolist()))
        return pa.table({
            "word": pa.array([a.decode("latin-1") for a, _ in out], pa.string()),
            "near": pa.array([b.decode("latin-1") for _, b in out], pa.string()),
            "near_n": pa.array([known[b] for _, b in out], pa.int64()),
        })

    # searching costs far more than the bytes of a block tell: one partition for each part of the shuffle
    entries = _entries(words).repartition(shuffle_width(words.sparkSession), "block")
    found = entries.groupBy("block").applyInArrow(search, "word STRING, near STRING, near_n BIGINT")
    return found.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """Per word with a form the end of its chain of forms: word, root."""
    current = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = current.select(F.col("word").alias("at"), F.col("root").alias("further"))
        moved = stored(
            current.join(further, F.col("root") == F.col("at"), "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "roots",
        )
        current = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return current


def variants(docs: DataFrame) -> DataFrame:
    """Per word: word, n, n_near, form, form_n, root."""
    words = stored(vocabulary(docs), "vocabulary")
    best = near_pairs(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near"))).alias("best")
    )
    much = -F.col("best.minus_n") >= RATIO * F.col("n")
    known = stored(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(much, F.col("best.near")).alias("form"), F.when(much, -F.col("best.minus_n")).alias("form_n"),
        ),
        "variants",
    )
    ends = roots(known.filter("form IS NOT NULL"))
    return known.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
