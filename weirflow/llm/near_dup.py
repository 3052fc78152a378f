"""Near-duplicate documents: an exact Jaccard join on word shingles by parity sketches.

A document is the set of its five-word shingles, each a 64-bit hash. Documents fall into
size bands; within a band the hash space is cut into segments, and a document's segments
hold the XOR of the shingles that fall into them. Two sets that differ in ``d`` shingles
differ in at most ``d`` segments. A similarity of 0.8 bounds ``d`` by a quarter of the
smaller set's size, so by the pigeonhole principle the first ``d + 1`` segments of each,
in one fixed order of all, have one in common. Those are the join keys. The fullest
segments come first: they hold several shingles, so that a passage or line which many
documents share rarely makes a key on its own. A larger document also takes part in the band below if it is within a quarter of
it. Candidates whose parity sketches differ in more bits than ``d`` are dropped (each
differing shingle flips one bit): a first sketch of 256 bits, then one of two bits or more
for each shingle. The others are verified on whole shingle sets.

Linking needs no pair list. In a first round each member of a key's group is compared
with the smallest member; the links give components. In a second round groups that still hold
several components compare these first, as wholes, once for each two components however many keys they share,
and then only the members of components that may have similar ones; so groups of copies,
however large, cost as much as their number. Keys that hold a large share of the rows
are found from a hash sample of documents and spread over as many parts as there are
shuffle partitions, each with a smallest member of its own; the sample affects only the
spreading, never the result.

Defined results: a null, empty or blank text has no shingles and is linked with nothing;
a text of fewer than five words is one shingle; equal sets are always linked; rows that
repeat a ``doc_id`` stand for it together; rows without ``doc_id`` are
left out of links and have a null component; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import free_name, shuffle_width, small_side, stored

WORDS = 5
NUMERATOR, DENOMINATOR = 4, 5  # the similarity that links, 0.8
#: Band limits grow by half; from this size on a segment holds up to three shingles.
FIRST, GROWTH, COARSE_FROM = 12, 1.5, 96
#: Keys held by more than one in so many sampled documents are spread.
HOT_SHARE, SAMPLE = 500, 64
#: So many keys of a component are looked at to tell under which of its keys a pair is made.
FIRST_KEYS = 16

_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)


def mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit values from 64-bit values, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    array = np.empty(len(words), object)
    array[:] = words
    return pd.util.hash_array(array, categorize=False)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a whole text, letters A-Z in lower case."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII white space and letters
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < WORDS:
        # tagged by its length: no shorter sequence equals a shingle
        return mixed(word_hashes([b" ".join([*words, b"%d" % len(words)])]))
    hashes = word_hashes(words)
    n = len(words) - WORDS + 1
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for k in range(WORDS):
            total = mixed((total ^ hashes[k : k + n]) * _MULTIPLIERS[k])
    return np.unique(total)


def parity_sketch(hashes: np.ndarray) -> np.ndarray:
    """256 bits as four integers, each bit the parity of the number of shingles that fall on it."""
    counts = np.bincount((hashes & np.uint64(255)).astype(np.int64), minlength=256)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64)


def full_sketch(hashes: np.ndarray) -> np.ndarray:
    """The same with at least two bits for each shingle, a power of two; halves fold into the smaller size."""
    bits = 256
    while bits < 2 * len(hashes):
        bits *= 2
    counts = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64)


def band_of(size: int) -> int:
    band, limit = 0, FIRST
    while size > limit:
        band, limit = band + 1, int(limit * GROWTH)
    return band


def band_limit(band: int) -> int:
    limit = FIRST
    for _ in range(band):
        limit = int(limit * GROWTH)
    return limit


def segments_of(limit: int) -> int:
    """More segments than any allowed difference in a band up to ``limit``."""
    return limit if limit < COARSE_FROM else -(-limit // 3)


def segment_keys(hashes: np.ndarray, band: int, differences: int) -> np.ndarray:
    """Keys of the first ``differences + 1`` segments in the band's order."""
    m = segments_of(band_limit(band))
    salt = np.uint64(0x1000193 * (band + 1))
    with np.errstate(over="ignore"):
        own = mixed(hashes ^ mixed(np.array([salt], np.uint64))[0])
        segment = ((own >> np.uint64(32)) % np.uint64(m)).astype(np.int64)
        content = np.zeros(m, np.uint64)
        np.bitwise_xor.at(content, segment, own)
        # fullest first: equal segments are equally full, so this is one order for all documents
        fullness = np.bincount(segment, minlength=m)
        chosen = np.argsort(-fullness, kind="stable")[: differences + 1]
        keys = mixed(content[chosen] + (chosen.astype(np.uint64) + np.uint64(1)) * _MULTIPLIERS[0] + salt * _MULTIPLIERS[1])
    return keys


def join_keys(hashes: np.ndarray) -> np.ndarray:
    """All keys under which a document is compared with others."""
    n = len(hashes)
    if not n:
        return hashes
    band = band_of(n)
    # |A xor B| <= (|A| + |B|) * (1 - t) / (1 + t), a ninth of the sum at 0.8
    factor = DENOMINATOR - NUMERATOR, DENOMINATOR + NUMERATOR
    largest = n * DENOMINATOR // NUMERATOR
    keys = [segment_keys(hashes, band, (n + largest) * factor[0] // factor[1])]
    if band and (below := band_limit(band - 1)) * DENOMINATOR >= n * NUMERATOR:
        keys.append(segment_keys(hashes, band - 1, (n + below) * factor[0] // factor[1]))
    return np.concatenate(keys)


def lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))


def profiles(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, set_id (equal for equal sets), sketch and join keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                sizes, ids, sketches, full, keys = [], [], [], [], []
                for text in part.column(1).to_pylist():
                    own = shingles(text)
                    sizes.append(len(own))
                    ids.append(hashlib.blake2b(own.tobytes(), digest_size=12).digest())
                    sketches.append(parity_sketch(own))
                    full.append(full_sketch(own))
                    keys.append(join_keys(own).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(ids, pa.binary()),
                        *(pa.array(s, pa.int64()) for s in np.array(sketches, np.int64).reshape(-1, 4).T),
                        lists(full),
                        lists(keys),
                    ],
                    ["doc_id", "n_shingles", "set_id", "s0", "s1", "s2", "s3", "sketch", "keys"],
                )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id BIGINT, n_shingles BIGINT, set_id BINARY, s0 BIGINT, s1 BIGINT, s2 BIGINT, s3 BIGINT, sketch ARRAY<BIGINT>, keys ARRAY<BIGINT>"
    )


def shingle_sets(docs: DataFrame) -> DataFrame:
    """Per row: doc_id and its shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                sets = [shingles(t).view(np.int64) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), lists(sets)], ["doc_id", "shingles"])

    return docs.mapInArrow(run, "doc_id BIGINT, shingles ARRAY<BIGINT>")


def possible(a: str, b: str):
    """Sizes and sketches of two sides, told apart by suffix, that allow the similarity."""
    n_a, n_b = F.col(f"n_shingles{a}"), F.col(f"n_shingles{b}")
    distance = sum(
        (F.bit_count(F.col(f"s{k}{a}").bitwiseXOR(F.col(f"s{k}{b}"))) for k in range(4)), F.lit(0)
    )
    return (F.least(n_a, n_b) * DENOMINATOR >= F.greatest(n_a, n_b) * NUMERATOR) & (
        distance * (DENOMINATOR + NUMERATOR) <= (n_a + n_b) * (DENOMINATOR - NUMERATOR)
    )


def folded_distance(a: Column, b: Column) -> Column:
    """Differing bits of two full sketches; the larger, at most twice as large, is folded."""

    def fold(x: Column, size: Column) -> Column:
        halves = F.zip_with(F.slice(x, F.lit(1), size), F.slice(x, size + 1, size), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) == size, x).otherwise(halves)

    size = F.least(F.size(a), F.size(b))
    bits = F.zip_with(fold(a, size), fold(b, size), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(bits, F.lit(0), lambda total, n: total + n)


def candidates(pairs: DataFrame, profile: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and sketches allow."""
    known = profile.select("doc_id", "n_shingles", "s0", "s1", "s2", "s3")
    left = known.select(*(F.col(c).alias(f"{c}_a") for c in known.columns))
    right = known.select(*(F.col(c).alias(f"{c}_b") for c in known.columns))
    rough = stored(
        pairs.join(left, F.col("a") == F.col("doc_id_a")).join(right, F.col("b") == F.col("doc_id_b"))
        .filter(possible("_a", "_b")).select("a", "b").distinct(),
        "rough-candidates",
    )
    left = profile.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("sketch_a"))
    right = profile.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("sketch_b"))
    near = folded_distance(F.col("sketch_a"), F.col("sketch_b")) * (DENOMINATOR + NUMERATOR) <= (
        F.col("n_a") + F.col("n_b")
    ) * (DENOMINATOR - NUMERATOR)
    needed = small_side(stored(rough.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "needed"))
    left, right = (s.join(needed, s[c] == needed["id"], "left_semi") for s, c in ((left, "a"), (right, "b")))
    return rough.join(left, "a").join(right, "b").filter(near).select("a", "b").distinct()


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    needed = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "needed")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(small_side(needed), "doc_id", "left_semi")
    sets = stored(shingle_sets(texts), "shingle-sets")
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
    both = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return both.filter(common * DENOMINATOR >= union * NUMERATOR).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """The smallest reachable node of every node of (a, b) edges.

    Each round joins every node's neighbours to the smallest node around it, first from
    the larger then to all, until no edge changes; stars double their reach per round.
    """
    # (node, low) with low < node
    current = stored(
        edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("low")).filter("node <> low").distinct(),
        "edges",
    )
    state = current.agg(F.count("*").alias("n"), F.sum(F.hash("node", "low").cast("bigint")).alias("h")).first()
    while state["n"]:
        # large star: each node's larger neighbours move to the smallest of its neighbours and itself
        both = current.select(F.col("node").alias("u"), F.col("low").alias("v")).unionByName(
            current.select(F.col("low").alias("u"), F.col("node").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("node"), F.col("m").alias("low"))
        large = large.distinct()
        # small star: each node's smaller neighbours, and itself, move to the smallest of them
        small_least = large.groupBy("node").agg(F.min("low").alias("m"))
        small = large.join(small_least, "node").filter("low <> m").select(F.col("low").alias("node"), F.col("m").alias("low"))
        small = small.unionByName(small_least.select("node", F.col("m").alias("low"))).distinct()
        current = stored(small, "edges")
        before = state
        state = current.agg(F.count("*").alias("n"), F.sum(F.hash("node", "low").cast("bigint")).alias("h")).first()
        if state == before:
            break
    return current.select("node", F.col("low").alias("component"))


def spread(keyed: DataFrame, profile: DataFrame) -> DataFrame:
    """``keyed`` with the part of its key: 0, or for a hot key one of many by document.

    Hot keys are held by more than one in HOT_SHARE documents of a hash sample. A
    document has a bounded number of keys per shingle, so there are at most HOT_SHARE
    times the mean number of keys of them, whatever the number of documents.
    """
    spark = keyed.sparkSession
    sample = profile.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    floor = max(sample.count() // HOT_SHARE, 8)
    hot = stored(
        sample.select(F.explode("keys").alias("key")).groupBy("key").count().filter(F.col("count") >= floor)
        .select("key", F.lit(shuffle_width(spark)).alias("parts")),
        "hot-keys",
    )
    part = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("parts")), F.lit(0))
    return keyed.join(F.broadcast(hot), "key", "left").select(
        "key", "doc_id", part.alias("part"), F.col("parts").isNotNull().alias("hot")
    )


SKETCH = range(4)


def component_profiles(members: DataFrame) -> DataFrame:
    """Per component its number of members, its sizes, and the sketch bits that all members have, or any."""
    return members.groupBy("component").agg(
        F.count("*").alias("number"), F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"),
        *(F.bit_and(f"s{k}").alias(f"all{k}") for k in SKETCH), *(F.bit_or(f"s{k}").alias(f"any{k}") for k in SKETCH),
    )


def may_hold_similar(a: str, b: str):
    """Profiles of two sides, told apart by suffix, that allow similar members.

    Bits that all members of one side have and no member of the other are lower bounds of the difference.
    """

    def opposed(k: int):
        one = F.col(f"all{k}{a}").bitwiseAND(F.bitwise_not(F.col(f"any{k}{b}")))
        return F.bit_count(one.bitwiseOR(F.col(f"all{k}{b}").bitwiseAND(F.bitwise_not(F.col(f"any{k}{a}")))))

    distance = sum((opposed(k) for k in SKETCH), F.lit(0))
    return (
        (F.col(f"most{a}") * DENOMINATOR >= F.col(f"least{b}") * NUMERATOR)
        & (F.col(f"most{b}") * DENOMINATOR >= F.col(f"least{a}") * NUMERATOR)
        & (distance * (DENOMINATOR + NUMERATOR) <= (F.col(f"most{a}") + F.col(f"most{b}")) * (DENOMINATOR - NUMERATOR))
    )


def component_pairs(opened: DataFrame, profile: DataFrame) -> DataFrame:
    """Pairs (c1, c2) of components, the one with more members first, that share a key and may hold similar documents.

    Keys held by the same components count once, and a pair that shares several keys is made under
    the first of them, as far as the first ``FIRST_KEYS`` of each component tell.
    """
    held = stored(opened.select("key", "component").distinct(), "held")
    sets = held.groupBy("key").agg(
        F.count("*").alias("n"),
        *(F.sum(F.xxhash64(F.lit(k), "component").cast("decimal(38,0)")).alias(f"h{k}") for k in range(2)),
    )
    kept = stored(sets.groupBy("n", "h0", "h1").agg(F.min("key").alias("key")).select("key"), "kept-keys")
    held = stored(held.join(kept, "key", "left_semi"), "held")
    rank = Window.partitionBy("component").orderBy("key")
    firsts = (
        held.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= FIRST_KEYS)
        .groupBy("component").agg(F.collect_list("key").alias("firsts"))
    )
    sides = held.join(profile.join(firsts, "component"), "component")
    left, right = (sides.select("key", *(F.col(c).alias(f"{c}_{s}") for c in sides.columns if c != "key")) for s in "ab")
    first = F.array_min(F.array_intersect("firsts_a", "firsts_b"))
    both = left.alias("l").join(
        right.alias("r"),
        (F.col("l.key") == F.col("r.key")) & (F.col("component_a") < F.col("component_b")) & may_hold_similar("_a", "_b")
        & (F.coalesce(first, F.col("l.key")) == F.col("l.key")),
    )
    larger = F.col("number_a") >= F.col("number_b")
    return both.select(
        F.when(larger, F.col("component_a")).otherwise(F.col("component_b")).alias("c1"),
        F.when(larger, F.col("component_b")).otherwise(F.col("component_a")).alias("c2"),
    ).distinct()


def across_components(opened: DataFrame, profile: DataFrame) -> DataFrame:
    """Pairs (a, b) of documents of different components with a key in common that sizes and sketches allow.

    ``opened``: key, doc_id, component of the groups that still hold several components. A
    member of the larger component is first held against the smaller one as a whole.
    """
    known = ["doc_id", "n_shingles", "s0", "s1", "s2", "s3"]
    members = stored(
        opened.select("doc_id", "component").distinct().join(profile.select(*known), "doc_id"), "members"
    )
    wholes = stored(component_profiles(members), "component-profiles")
    pairs = stored(component_pairs(opened, wholes), "component-pairs")
    pairs = pairs.join(wholes.select(F.col("component").alias("c2"), *(F.col(c).alias(f"{c}_w") for c in wholes.columns[1:])), "c2")
    left = members.select(
        F.col("component").alias("c1"), *(F.col(c).alias(f"{c}_a") for c in known),
        *(F.col("n_shingles").alias(f"{c}_x") for c in ("least", "most")),
        *(F.col(f"s{k}").alias(f"{c}{k}_x") for c in ("all", "any") for k in SKETCH),
    )
    right = members.select(F.col("component").alias("c2"), *(F.col(c).alias(f"{c}_b") for c in known))
    one = pairs.alias("p").join(left.alias("m"), (F.col("p.c1") == F.col("m.c1")) & may_hold_similar("_x", "_w"))
    one = stored(one.select("c2", *(f"{c}_a" for c in known)), "members-and-components")
    both = one.join(right, "c2").filter(possible("_a", "_b"))
    return both.select(F.least("doc_id_a", "doc_id_b").alias("a"), F.greatest("doc_id_a", "doc_id_b").alias("b")).distinct()


def near_edges(docs: DataFrame, profile: DataFrame, copies: DataFrame) -> DataFrame:
    """Pairs (a, b) whose components are those of all links between different sets."""
    single = profile.filter("n_shingles > 0 AND doc_id IS NOT NULL").join(
        small_side(copies.select(F.col("b").alias("doc_id"))), "doc_id", "left_anti"
    )
    keyed = spread(single.select("doc_id", F.explode("keys").alias("key")), profile)
    group = Window.partitionBy("key", "part")
    groups = stored(
        keyed.select("*", F.count("*").over(group).alias("n"), F.min("doc_id").over(group).alias("low"))
        .filter("n > 1 OR hot").select("key", "doc_id", "low", "hot"),
        "groups",
    )
    # first round: members with the smallest of their group, and those of one hot key with each other
    tops = groups.filter("hot").groupBy("key").agg(F.min("low").alias("a"))
    lows = groups.filter("hot").select("key", F.col("low").alias("b")).distinct()
    pairs = (
        groups.select(F.col("low").alias("a"), F.col("doc_id").alias("b"))
        .unionByName(lows.join(tops, "key").select("a", "b"))
        .filter("a <> b").distinct()
    )
    first = stored(candidates(pairs, profile), "candidates")
    links = stored(verified(first, docs), "verified")
    # second round: members of one group that are still in different components
    labels = components(links)
    labelled = groups.select("key", "doc_id").distinct().join(
        labels, F.col("doc_id") == F.col("node"), "left"
    ).select("key", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    opened = labelled.groupBy("key").agg(F.min("component").alias("c1"), F.max("component").alias("c2"))
    opened = stored(labelled.join(opened.filter("c1 <> c2"), "key", "left_semi"), "open-groups")
    across = across_components(opened, profile)
    second = stored(candidates(across, profile).join(first, ["a", "b"], "left_anti"), "candidates")
    stars = labels.select(F.col("component").alias("a"), F.col("node").alias("b"))
    if second.isEmpty():
        return stars
    return stars.unionByName(verified(second, docs))


def link(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id."""
    profile = stored(profiles(docs), "profiles")
    members = profile.filter("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", "set_id")
    # equal sets are linked to the smallest document that has the set, which stands for all from here on
    repeated = stored(
        members.groupBy("set_id").agg(F.min("doc_id").alias("a"), F.count("*").alias("n")).filter("n > 1").drop("n"),
        "repeated-sets",
    )
    copies = stored(
        members.join(small_side(repeated), "set_id").filter("doc_id <> a").select("a", F.col("doc_id").alias("b")), "copies"
    )
    labels = components(copies.unionByName(near_edges(docs, profile, copies)))
    return (
        profile.select("doc_id", "n_shingles")
        .join(labels, F.col("doc_id") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its component; texts without shingles stay."""
    other_id = free_name(docs, "_other_id")
    others = stored(
        link(docs).filter("doc_id <> component_id").select(F.col("doc_id").alias(other_id)).distinct(), "near-copies"
    )
    return docs.join(small_side(others), docs["doc_id"].cast("bigint") == F.col(other_id), "left_anti")
