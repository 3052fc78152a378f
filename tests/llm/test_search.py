"""Ranked search, fingerprints and spelling variants against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from weirflow.llm import lexical_search, spelling_variants, weighted_sampling
from weirflow.llm.common import table
from weirflow.llm.queries import CORPUS_QUERIES

SMALL = "/root/testdata/sf0.001"
A_TO_Z = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def items(spark):
    def make(rows):
        return spark.createDataFrame(
            [(i, t, 1, "s", 2) for i, t in rows], "item_id BIGINT, text STRING, rank INT, terms STRING, n INT"
        )

    return make


# ---- ranked search ----


def brute_ranks(docs, items):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(A_TO_Z))

    counted = [(i, Counter(own), len(own)) for i, t in docs if (own := terms(t))]
    n_docs, total = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        own = Counter(terms(text))
        scores = []
        for i, c, n in counted:
            m = 100 - 25 + (25 * n * n_docs) // total
            score = sum(
                r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t, r in own.items() if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, k, i, -s) for k, (s, _, _, i) in enumerate(sorted(scores)[:20], 1)]
    return Counter(out)


QUESTIONS = [(1, "One two a b zebra"), (2, None), (3, "?!"), (None, "w5x5 w5x5 w6x6 c"), (1, "é 你好 one"), (9, "absent")]


def test_search_equals_brute_force(spark, documents, items, odd_texts, monkeypatch):
    rng = random.Random(5)
    vocabulary = ["one", "two", "a", "b", "c", "Zebra", "é", "x-y", "w5x5"]
    docs = odd_texts + [(100 + k, " ".join(rng.choices(vocabulary, k=rng.randint(1, 30)))) for k in range(150)]
    docs += [(300 + k, "one two") for k in range(40)]  # ties
    got = lexical_search.ranked(documents(docs).repartition(5), items(QUESTIONS))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = brute_ranks(docs, QUESTIONS)
    assert Counter(map(tuple, got.collect())) == want
    # many blocks of items, and pieces of a text, give the same
    monkeypatch.setattr(lexical_search, "POSTINGS", 4)
    monkeypatch.setattr(lexical_search, "PIECE", 50)
    assert Counter(map(tuple, lexical_search.ranked(documents(docs), items(QUESTIONS)).collect())) == want


def test_search_of_empty_tables(documents, items):
    assert lexical_search.ranked(documents([]), items(QUESTIONS)).collect() == []
    assert lexical_search.ranked(documents([(1, "one")]), items([])).collect() == []
    assert lexical_search.ranked(documents([(1, None), (2, "")]), items(QUESTIONS)).collect() == []


# ---- fingerprints ----


def brute_edits(rows):
    """Per row its edited text and the text of its next document."""
    texts = defaultdict(list)
    for i, t in rows:
        texts[-(1 << 63) if i is None else i].append(t or "")
    order = sorted(texts)
    after = {a: min(texts[b]) for a, b in zip(order, order[1:] + order[:1])}
    out = []
    for i, t in rows:
        t, following = t or "", after[-(1 << 63) if i is None else i]
        half = len(t) // 2
        out.append((i, t, t[: len(t) - half] + following[:half], following))
    return out


def check_fingerprints(got, rows):
    want = brute_edits(rows)
    texts = sorted({x for _, *r in want for x in r})
    of = {t: f.hex() for t, f in zip(texts, weighted_sampling.fingerprints(texts))}
    expected = Counter(
        (i, len(t), hashlib.sha256(e.encode()).hexdigest(), of[t], of[e],
         weighted_sampling.likeness(bytes.fromhex(of[t]), bytes.fromhex(of[e])),
         weighted_sampling.likeness(bytes.fromhex(of[t]), bytes.fromhex(of[f])))
        for i, t, e, f in want
    )
    assert Counter(map(tuple, got)) == expected


def test_fingerprints_of_odd_rows(documents, odd_texts):
    rows = odd_texts + [(50 + 3 * k, f"text number {k} of some more words {'x ' * k}") for k in range(60)]
    check_fingerprints(weighted_sampling.with_edits(documents(rows).repartition(3)).collect(), rows)
    assert weighted_sampling.with_edits(documents([])).collect() == []
    check_fingerprints(weighted_sampling.with_edits(documents([(7, "ab cd")])).collect(), [(7, "ab cd")])
    same = [(4, "a b c d")] * 3 + [(None, "x y")] * 2
    check_fingerprints(weighted_sampling.with_edits(documents(same)).collect(), same)


def test_fingerprint_query(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    got = CORPUS_QUERIES["op12_fingerprints"](spark, SMALL).collect()
    check_fingerprints(got, rows)
    assert np.mean([r.near_edited for r in got]) > 0.3 > np.mean([r.near_next for r in got])
    signed = {r.doc_id: r.fingerprint for r in weighted_sampling.signed(table(spark, SMALL, "documents")).collect()}
    assert signed == {r.doc_id: r.fingerprint for r in got}


def test_many_limits_place_keys(spark):
    for limits in ([], [5], [1, 2, 3], list(range(0, 70, 3))):
        keys = spark.range(-2, 75).select(F.col("id").alias("k"), weighted_sampling._place(F.col("id"), limits).alias("p"))
        assert all(r.p == sum(x <= r.k for x in limits) for r in keys.collect())


def test_samples_agree_as_often_as_documents_are_alike():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(400)]
    errors = []
    for _ in range(30):
        a = rng.choices(vocabulary[:250], k=300)
        b = a[: rng.randint(0, 300)] + rng.choices(vocabulary[100:], k=200)
        one, two = weighted_sampling.fingerprints([" ".join(a), " ".join(b)], 512)
        a, b = Counter(a), Counter(b)
        errors.append(weighted_sampling.likeness(one, two) - sum((a & b).values()) / sum((a | b).values()))
    assert abs(np.mean(errors)) < 0.01 and max(map(abs, errors)) < 0.09


def test_words_and_levels(monkeypatch):
    assert weighted_sampling.words('Ab "ab," ... É x-y (AB)') == Counter({b"ab": 3, b"...": 1, "É".encode(): 1, b"x-y": 1})
    one, two, three = weighted_sampling.fingerprints(["", " \n", "a"])
    assert one == two == bytes(128) and weighted_sampling.likeness(one, three) == 0
    text = " ".join(f"w{k % 700} w{k % 13}" for k in range(3000))
    whole = weighted_sampling.fingerprints([text])
    monkeypatch.setattr(weighted_sampling, "WORDS", 7)  # in small blocks
    assert weighted_sampling.fingerprints([text]) == whole


# ---- spelling variants ----


def brute_words(rows):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", t or ""):
            run = run.translate(A_TO_Z)
            if i is not None and (h := zlib.crc32(f"{i}:{run}".encode())) % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def brute_near(words):
    """Pairs one code point apart, by what is left of each without one letter."""
    holes, shorter = defaultdict(set), defaultdict(set)
    for w in words:
        for k in range(len(w)):
            holes[w[:k], w[k + 1 :]].add(w)
            shorter[w[:k] + w[k + 1 :]].add(w)
    near = defaultdict(set)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    for w in words:
        for longer in shorter.get(w, ()):
            near[w].add(longer)
            near[longer].add(w)
    return near


def brute_variants(rows):
    counts = brute_words(rows)
    near = brute_near(set(counts))
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = Counter()
    for w, n in counts.items():
        end = w
        while form[end] is not None:
            end = form[end]
        out[w, n, len(near[w]), form[w], counts.get(form[w]), end] += 1
    return out


def found_variants(frame):
    return Counter(map(tuple, frame.select("word", "n", "n_near", "form", "form_n", "root").collect()))


def misspelt_rows(seed, count):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abcé", k=rng.randint(5, 11))) for _ in range(40)]
    words = []
    for stem in stems:
        for _ in range(rng.randint(1, 6)):
            own, k = list(stem), rng.randrange(len(stem))
            own[k : k + 1] = rng.choice([[], [own[k], rng.choice("abcÿ")], [rng.choice("abc")]])
            words += ["".join(own)] * rng.randint(1, 4)
        words += [stem] * rng.randint(1, 20)
    chain = "levels " * 40 + "levelss " * 12 + "levelsss " * 4
    return [(k, " ".join(rng.choices(words, k=60)) + ".") for k in range(count)] + [(count, chain)]


def test_variants_equal_brute_force(documents, odd_texts, monkeypatch):
    rows = misspelt_rows(1, 60) + odd_texts + [(None, "Straße straße STRASSE, naïve naive Naïve naïve")] * 3
    want = brute_variants(rows)
    assert sum(form is not None for _, _, _, form, _, _ in want) > 20 and any(r[3] and r[3] != r[5] for r in want)
    assert found_variants(spelling_variants.variants(documents(rows).repartition(3))) == want
    # small blocks cut pieces into parts; small lists cut texts
    for name, value in (("BLOCK", 5), ("PIECE", 64), ("KEPT", 10), ("QUERIES", 7), ("STEP", 4)):
        monkeypatch.setattr(spelling_variants, name, value)
    assert found_variants(spelling_variants.variants(documents(rows))) == want


def test_variants_query(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    assert found_variants(CORPUS_QUERIES["op13_spelling_variants"](spark, SMALL)) == brute_variants(rows)


def test_variants_of_empty_tables(documents):
    assert spelling_variants.variants(documents([])).collect() == []
    assert spelling_variants.variants(documents([(1, None), (2, "a b c 123"), (3, "words words")])).collect() == []


def test_long_chains_of_forms(spark):
    chain = [(f"w{k:03}", f"w{k + 1:03}") for k in range(50)]
    forms = spark.createDataFrame(chain, "word STRING, form STRING")
    assert {r.root for r in spelling_variants.roots(forms).collect()} == {"w050"}


def test_index_counts_and_finds():
    rng = random.Random(8)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(5, 8))).encode() for _ in range(300)})
    index = spelling_variants.Variants(words)
    text = b"\0" + b"\0".join(words) + b"\0"
    assert sorted(range(len(text)), key=lambda k: text[k:]) == index.indexes[0].ranks.tolist()
    found = {(words[i], words[j]) for a, b in index.near(words) for i, j in zip(a.tolist(), b.tolist())}
    near = brute_near({w.decode() for w in words})
    assert found == {(a.encode(), b.encode()) for a in near for b in near[a]}
