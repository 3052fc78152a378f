"""Exact copies, near copies and leaks against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from weirflow.llm import decontamination, exact_dedup, near_dup
from weirflow.llm.queries import CORPUS_QUERIES

SMALL = "/root/testdata/sf0.001"


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < 5 else frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_components(rows):
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, (i, own) in enumerate(sets):
        shared = Counter(o for g in own for o in holders[g])
        for o, n in shared.items():
            if 100 * n >= 80 * (len(own) + len(sets[o][1]) - n):
                a, b = root(i), root(sets[o][0])
                parent[max(a, b)] = min(a, b)
        for g in own:
            holders[g].append(k)
    return {i: root(i) for i in parent}


def near_rows(seed):
    """Groups of near copies around the limit, with shared passages and chains."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=40)
    rows, n = [], 0
    for size in (5, 6, 9, 14, 25, 40, 70, 120, 260):
        for _ in range(4):
            base = rng.choices(vocabulary, k=size)
            if rng.random() < 0.5:
                base[size // 2 : size // 2] = passage
            for _ in range(rng.randint(1, 5)):
                own = list(base)
                for _ in range(rng.randint(0, max(1, len(own) // 25))):
                    own[rng.randrange(len(own))] = rng.choice(vocabulary)
                base = own if rng.random() < 0.3 else base
                rows.append((n, " ".join(own)))
                n += 1
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(documents, seed):
    rows = near_rows(seed)
    got = {r.doc_id: r for r in near_dup.link(documents(rows)).collect()}
    want = brute_components(rows)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(got[i].n_shingles == len(shingle_set(t)) for i, t in rows)


def test_components_of_odd_texts(documents, odd_texts):
    rows = near_dup.link(documents(odd_texts)).collect()
    assert len(rows) == len(odd_texts)
    want = brute_components(odd_texts)
    assert all(r.component_id == want.get(r.doc_id) for r in rows)
    assert want[8] == 7 and want[5] == want[6] == 4
    assert near_dup.link(documents([])).collect() == []


def test_one_of_each_keeps_texts_without_shingles(documents, odd_texts):
    kept = near_dup.one_of_each(documents(odd_texts))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 7, 9, 9, 10, 11]
    assert "_copy_id" in kept.columns


@pytest.mark.parametrize("size", [1, 2, 3, 11, 12, 13, 30, 95, 96, 200, 1000])
def test_sets_at_the_limit_share_a_key(size):
    import numpy as np

    rng = np.random.default_rng(size)
    for _ in range(20):
        a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        drop = rng.integers(0, size // 5 + 1)
        add = int(len(a) * 5 // 4 - len(a)) if not drop else max(0, int((len(a) - drop) / 0.8 - len(a)))
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 63, add).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        if len(b) and 5 * common >= 4 * (len(a) + len(b) - common):
            assert set(near_dup.join_keys(a).tolist()) & set(near_dup.join_keys(b).tolist())


def test_exact_copies_of_odd_texts(spark, documents, odd_texts):
    rows = exact_dedup.deduplicate(documents(odd_texts), exact_dedup.fresh_index(spark)).collect()
    texts = {}
    for i, t in odd_texts:
        texts.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    want = Counter()
    for text, ids in texts.items():
        keep = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).digest()
        want.update((i, keep, len(ids), i == keep, digest) for i in ids)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest)) for r in rows) == want
    assert exact_dedup.deduplicate(documents([]), exact_dedup.fresh_index(spark)).collect() == []


def test_index_persists_and_older_documents_stay(spark, documents, tmp_path):
    path = str(tmp_path / "index")
    first = exact_dedup.DigestIndex.open(spark, "digests_a", path, buckets=3)
    exact_dedup.deduplicate(documents([(5, "a"), (6, "b")]), first).collect()
    again = exact_dedup.DigestIndex.open(spark, "digests_b", path)  # as a new session would
    assert again.buckets == 3
    rows = exact_dedup.deduplicate(documents([(1, "a"), (2, "c"), (5, "a")]), again)
    assert {(r.doc_id, r.keep_id, r.kept) for r in rows.collect()} == {(1, 5, False), (2, 2, True), (5, 5, True)}
    other = spark.table("digests_a").hint("merge")
    plan = again.table().join(other, "digest")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_without_copies(spark, documents, odd_texts):
    kept = exact_dedup.without_copies(documents(odd_texts), exact_dedup.fresh_index(spark)).collect()
    assert sorted(r.doc_id for r in kept) == [1, 3, 4, 6, 7, 8, 9, 9, 10, 11]


ITEMS = [
    (1, "What is the tallest tower of the northern harbour city? It is the old copper lighthouse."),
    (2, "Name two minerals that colour the river sand near the southern delta in spring."),
    (3, None), (4, ""), (5, "too short"),
    (6, "What is the tallest tower of the northern harbour city? It is the old copper lighthouse."),
]


def test_leaks(spark, documents, odd_texts):
    filler = " ".join(f"filler{i % 211}" for i in range(3000))
    rows = [
        *odd_texts,
        (20, f"{filler} {ITEMS[0][1]} {filler}"), (21, f"{filler[:777]} {ITEMS[1][1].upper()}"),
        (22, "the tallest tower of the city is old and it is near the river in spring"), (23, filler),
        (24, ITEMS[1][1].replace(" ", "\n,")), (25, f"{ITEMS[0][1]} {ITEMS[0][1]}"),
    ]
    items = spark.createDataFrame(ITEMS, "item_id BIGINT, text STRING")
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(documents(rows), items).collect()}
    assert got == {(20, 1), (20, 6), (21, 2), (24, 2), (25, 1), (25, 6)}
    kept = decontamination.without_leaks(documents(rows), items)
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {20, 21, 24, 25}
    empty = spark.createDataFrame([], "item_id BIGINT, text STRING")
    assert decontamination.leaks(documents(rows), empty).collect() == []


def test_short_items_leak_as_a_whole(spark, documents):
    items = spark.createDataFrame([(1, "Who wrote Faust? Goethe."), (2, "?!"), (3, ITEMS[0][1])], "item_id BIGINT, text STRING")
    filler = " ".join(f"filler{i % 211}" for i in range(300))
    rows = [
        (1, f"{filler} who wrote\nFAUST - Goethe {filler}"), (2, "Goethe wrote Faust, who else"), (3, "who wrote faust goethes"),
        (4, "?!"), (5, "who wrote faust"),
    ]
    assert [(r.doc_id, r.item_id) for r in decontamination.leaks(documents(rows), items).collect()] == [(1, 1)]
    assert sorted(r.doc_id for r in decontamination.without_leaks(documents(rows), items).collect()) == [2, 3, 4, 5]


def test_leaks_in_blocks_equal_one_index(spark, documents, monkeypatch):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    whole = {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, items).collect()}
    monkeypatch.setattr(decontamination, "ITEMS", 15)
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, items).collect()} == whole


def test_scores_do_not_depend_on_blocks(spark, monkeypatch):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    whole = sorted(map(tuple, decontamination.leaks(docs, items).collect()))
    monkeypatch.setattr(decontamination, "ITEM_WORDS", 300)
    assert whole and sorted(map(tuple, decontamination.leaks(docs, items).collect())) == whole


def test_every_retrieved_item_is_found_by_exhaustive_scoring(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    docs = [decontamination.words(r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    index = decontamination.Index(items, 0.3)
    want = set()
    for k, text in enumerate(docs):
        for start in range(0, len(text), index.stretch):
            part = text[start : start + 2 * index.stretch]
            has = {index.vocabulary[w] for w in part if w in index.vocabulary}
            for i, own in enumerate(index.weights):
                if sum(w for t, w in own.items() if t in has) >= 0.3:
                    grams = set().union(*(decontamination.grams(part, n) for n in (1, 2, 3)))
                    if all(len(p & grams) >= decontamination.OVERLAP * len(p) for p in index.parts[i]):
                        want.add((k, i))
    assert {(k, i) for k, i, *_ in index.search(docs)} == want


def test_registered_leaks_cover_verbatim_items(spark):
    rows = CORPUS_QUERIES["op5_decontamination"](spark, SMALL).collect()
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    verbatim = {(d, i) for d, t in docs.items() for i, x in items.items() if x and x in (t or "")}
    assert verbatim <= {(r.doc_id, r.item_id) for r in rows}
