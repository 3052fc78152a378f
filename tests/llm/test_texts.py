"""Tokens, classifiers, secrets, URLs, pages and shards on small fixtures."""

import hashlib
import html
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from weirflow.llm import html_template, quality, secrets, sentencepiece_codec, sharding, toxicity, url_filter
from weirflow.llm.queries import CORPUS_ORACLES, CORPUS_QUERIES, HOST_RULES, tokenizer

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    return tokenizer("piece_bpe_32k.model")


# ---- SentencePiece ----


def test_codec_equals_the_library(spark, documents, odd_texts, model):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=model)
    texts = [
        *odd_texts, (30, "▁ ▁▁x▁"), (31, "a\x00b\x7f"), (32, " lead"), (33, "trail  "), (34, "\n\n  x\r\n"),
        (35, "ﬁ ½ Å Å"), (36, "don't (stop) e.g. 3.14 -- [x]"), (37, "é" * 60 + "abcdefghij" * 30),
    ]
    rows = sentencepiece_codec.digests(documents(texts), model).collect()
    want = Counter()
    for i, t in texts:
        ids = library.encode(t or "")
        want[
            i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest(),
        ] += 1
    assert Counter(map(tuple, rows)) == want
    ids = sentencepiece_codec.encode(documents(texts), model)
    back = {r.doc_id: r.text for r in sentencepiece_codec.decode(ids, model).collect()}
    assert all(back[i] == library.decode(library.encode(t or "")) for i, t in texts)
    assert sentencepiece_codec.digests(documents([]), model).collect() == []


def test_heap_and_scan_merge_alike(model):
    codec = sentencepiece_codec.Codec(model)
    for unit in ("▁" * 19, "international", "aaaaaaaaaaaaaaaa", "▁thethethethe", "ñandúñandú"):
        assert codec.merge(unit) == codec._merge_long(list(unit))


def test_batches_and_segments_change_nothing(model, monkeypatch):
    codec = sentencepiece_codec.Codec(model)
    texts = [f"word{i}x  other{i * 7} text ▁ éü{i}" * (1 + i % 9) for i in range(200)] + ["", "x" * 300, "  ", None]
    want = [codec.library.encode(t or "") for t in texts]
    for rows, chars in ((500, 1 << 20), (7, 50), (1, 1)):
        monkeypatch.setattr(sentencepiece_codec, "ROWS", rows)
        monkeypatch.setattr(sentencepiece_codec, "CHARS", chars)
        got = codec.process(texts)
        assert [ids for ids, _, _ in got] == want
        assert [joined.decode() for _, joined, _ in got] == [",".join(map(str, i)) for i in want]
        assert [text for _, _, text in got] == [codec.library.decode(i) for i in want]


def test_whole_texts_are_compared_and_decoded_by_the_library(model, monkeypatch):
    codec = sentencepiece_codec.Codec(model)
    decoded = []

    class Library:
        def __getattr__(self, name):
            return getattr(library, name)

        def decode(self, ids, **how):
            decoded.extend(ids)
            return library.decode(ids, **how)

    library, codec.library = codec.library, Library()
    ((ids, _, text),) = codec.process(["one two  three"])
    assert decoded == [library.encode("one two  three")] == [ids] and text == library.decode(decoded[0])
    monkeypatch.setattr(codec, "joined", codec.joined & False)  # cuts that pieces span
    with pytest.raises(ValueError, match="differ"):
        codec.process(["international"])


# ---- toxicity ----


def kinds(text, entries=("idiot$", "vequ")):
    grammar = toxicity.Grammar(dict.fromkeys(entries, 1.0), toxicity.PRIOR)
    return [k for part in toxicity.CLAUSE.split(text.lower()) for k, _ in grammar.clause(toxicity.WORD.findall(part))]


@pytest.mark.parametrize(("text", "want"), [
    ("an idiot wrote this", ["insult"]), ("you are an idiot", ["targeted"]), ("what an idiot, you", ["targeted"]),
    ("not an idiot", ["negated"]), ("not in this very long clause an idiot", ["insult"]),
    ("he said idiot", ["reported"]), ("he said. idiot", ["insult"]), ("I will kill you", ["threat"]),
    ("kill the lights", []), ("I will never kill", ["negated"]), ("vequeur et idiots", ["insult"]), ("", []),
])
def test_grammar_composes(text, want):
    assert kinds(text) == want


def brute_kinds(words):
    """The kinds of a clause's matches, each told from the words around it."""
    classes = toxicity.prior().classes
    of = ["insult" if w == "idiot" else classes.get(w, "other") for w in words]
    out = []
    for k, kind in enumerate(of):
        near, before = of[max(0, k - 4) : k], of[:k]
        if kind == "threat" and "modal" not in near or kind not in ("insult", "threat"):
            continue
        out.append(
            "negated" if "negation" in near else "reported" if "report" in before else "threat" if kind == "threat"
            else "targeted" if "target" in of else "insult"
        )
    return out


def test_composition_equals_its_statement():
    rng = np.random.default_rng(4)
    words = ["idiot", "kill", "will", "you", "not", "said", "x", "y", "z", "w"]
    for _ in range(3000):
        own = rng.choice(words, rng.integers(0, 12)).tolist()
        assert kinds(" ".join(own)) == brute_kinds(own), own


def test_contrasts(spark):
    grammars = [toxicity.prior(), toxicity.fit(
        spark.read.parquet(f"{MIDDLE}/documents.parquet"), spark.read.parquet(f"{MIDDLE}/labels.parquet"), 5, 0
    )]
    for grammar in grammars:
        alone, aimed, twice = (grammar.score(t) for t in ("idiot", "You are an idiot", "idiot. what a moron"))
        assert alone < 0.5 <= min(aimed, twice)
        assert grammar.score("the book about trash is nice") < 0.5
        for text in ("You are not an idiot", "He said you are an idiot", "never an idiot"):
            assert grammar.score(text) < alone
        assert grammar.score("Du bist ein Dummkopf") >= 0.5 <= grammar.score("tu es un connard")


def test_learned_words_tell_held_out_texts_apart(spark):
    rows = CORPUS_QUERIES["op1_toxicity"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    got = Counter((r.toxic, r.predicted) for r in rows.filter("held_out").join(labels, "doc_id").collect())
    assert got[1, 1] / (got[1, 1] + got[1, 0]) > 0.85
    assert got[0, 1] / (got[0, 1] + got[0, 0]) < 0.01


def test_toxicity_of_odd_texts(spark, documents, odd_texts):
    none = spark.createDataFrame([(None, 1), (4, None)], "doc_id BIGINT, toxic INT")
    grammar = toxicity.fit(documents(odd_texts), none)
    rows = documents([*odd_texts, (40, "you are an idiot")]).select("doc_id", toxicity.score(grammar).alias("score")).collect()
    assert len(rows) == len(odd_texts) + 1
    assert all((r.score >= 0.5) == (r.doc_id == 40) for r in rows)
    assert documents([]).select(toxicity.score(grammar)).collect() == []


def test_held_out_labels_teach_nothing(spark, documents):
    rows = [(i, f"alpha beta gamma{i % 7}") for i in range(200)]
    labels = spark.createDataFrame([(i, int(zlib.crc32(str(i).encode()) % 5 == 0)) for i in range(200)], "doc_id BIGINT, toxic INT")
    sample = toxicity.labelled_sample(documents(rows), labels, 5, 0)
    assert {r.toxic for r in sample.collect()} == {0}


# ---- quality ----


def test_gradient_is_the_slope():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(n, quality.MEASURES)) for n in (1, 4, 2)]
    y = np.array([0.0, 1.0, 1.0])
    net = quality.learn(bags, np.array([0.0, 0.0, 0.0]))
    net.weights["out"] = rng.normal(size=quality.ENCODED)
    x, starts = np.concatenate(bags), np.array([0, 1, 5])

    def loss():
        p = net.forward(x, starts)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, g in net.gradient(x, starts, y).items():
        at = (0,) * g.ndim
        net.weights[name] = net.weights[name].copy()
        net.weights[name][at] += 1e-5
        up = loss()
        net.weights[name][at] -= 2e-5
        assert math.isclose((up - loss()) / 2e-5, g[at], rel_tol=1e-3, abs_tol=1e-7), name
        net.weights[name][at] += 1e-5


def test_quality_tells_held_out_texts_apart(spark):
    rows = CORPUS_QUERIES["op4_quality"](spark, MIDDLE)
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").select("doc_id", "quality")
    got = Counter((r.quality, r.predicted) for r in rows.filter("held_out").join(labels, "doc_id").collect())
    assert (got[0, 0] + got[1, 1]) / sum(got.values()) > 0.95


def test_quality_of_odd_texts(spark, documents, odd_texts):
    labels = spark.createDataFrame([(None, 1), (4, None), (5, 1)], "doc_id BIGINT, quality INT")
    network = quality.fit(documents(odd_texts), labels)
    rows = documents(odd_texts).select(quality.score(network).alias("s")).collect()
    assert len(rows) == len(odd_texts) and all(0 <= r.s <= 1 for r in rows)
    assert documents([]).select(quality.score(network)).collect() == []


# ---- secrets ----

SECRETS = [
    (1, None), (2, ""), (3, "password = hunter22 and TOKEN:'abc123'"), (4, "secret: token : abcdef"),
    (5, "😀é AKIA" + "A1" * 9 + " x AKIASHORT"), (6, "0123456789abcdef" * 3), (7, "deadbeefdeadbeefdeadbeeg"),
    (8, "api_key=\"Zx9/Qw8+Er7Ty6Ui5Op4\" apikey:::x"), (9, "key Zx9Qw8Er7Ty6Ui5Op4As3Df2Gh1 end"),
    (10, "550e8400-e29b-41d4-a716-446655440000 and some/long/path/of/words/x1"), (11, "token=short token=longer1"),
    (11, "token=short token=longer1"), (12, ("word " * 20_000) + "passwd:qwertz77"), (None, "PASSWD=ABCDEFG"),
]


def brute_base(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def brute_entropy(text, base):
    found = []
    for m in re.finditer(secrets.CANDIDATE, text):
        own = m[0]
        if re.search(secrets.ALLOWED.replace("(?i)", ""), own) or any(a < m.end() and m.start() < b for a, _, b in base):
            continue
        for k in range(len(own) - secrets.WINDOW + 1):
            part = own[k : k + secrets.WINDOW]
            bits = -sum(n / 20 * math.log2(n / 20) for n in Counter(part).values())
            digits, upper, lower = (len(re.findall(c, part)) for c in ("[0-9]", "[A-Z]", "[a-z]"))
            is_hex = re.fullmatch("[0-9a-f]+", part) and 3 <= digits <= 17
            if (is_hex and bits >= secrets.HEX_BITS) or (min(digits, upper, lower) >= 2 and bits >= secrets.MIXED_BITS):
                found.append((m.start(), 3, m.end()))
                break
    return found


def test_secret_spans_equal_brute_force(documents):
    rows = secrets.scan(documents(SECRETS)).collect()
    got = Counter((r.doc_id, tuple(map(tuple, r.base)), tuple(map(tuple, r.spans))) for r in rows)
    want = Counter()
    for i, t in SECRETS:
        base = brute_base(t or "")
        want[i, tuple(base), tuple(sorted(base + brute_entropy(t or "", base)))] += 1
    assert got == want
    assert any(k == 3 for _, _, spans in want for _, k, _ in spans)
    assert secrets.scan(documents([])).collect() == []


@pytest.mark.parametrize(("text", "found"), [
    ("K7QX2MZB4TLW5NPD6RVA3GYH", True), ("9F3A7C05E1B84D26F07A9C3E5B18", True), ("k7qx2mzb4tlw9npd0rva3gyh", True),
    ("example/Zx9Qw8Er7Ty6Ui5Op4As3Df2", True), ("Zx9Qw8Er7Ty6Ui5Op4As3Df2_1234567890", True),
    ("Zx9Qw8Er7exampleUi5Op4As3", False), ("0123456789ABCDEF0123456789ABCDEF", False),
    ("550E8400-E29B-41D4-A716-446655440000", False), ("some/long/path/of/words/x1", False), ("AAAAAAAAAA2222222222", False),
])
def test_entropy_spans_by_class(documents, text, found):
    (row,) = secrets.scan(documents([(1, f"é {text} .")])).collect()
    assert [tuple(s) for s in row.spans] == ([(2, 3, 2 + len(text))] if found else [])


def test_secret_scan_is_native(documents):
    plan = secrets.scan(documents(SECRETS))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


# ---- URLs ----

URLS = [
    (1, None), (2, ""), (3, "no scheme/de/"), (4, "https://Example.COM/de/x"), (5, "http://notexample.com/de/x"),
    (6, "http://a.example.net/en/"), (7, "http://a.example.net/en"), (8, "http://x.net"), (9, "http://x.net?q=/en/"),
    (10, "http://b.org/fr/1#x"), (11, "http://b.org/FR/1"), (12, "ftp://free-bets.example.org/es/1"),
    (12, "ftp://free-bets.example.org/es/1"), (13, "x://y://net/"), (14, "http://evil\n.net/a"), (None, "http://net/"),
]


def brute_url(url):
    rest = (url or "").partition("://")[2]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match(r"(?s)[^/?#]*", rest)[0])
    path = re.match(r"(?s)[^/?#]*([^?#]*)", rest)[1]
    fit = [r for r in HOST_RULES if (host == r.host or host.endswith(f".{r.host}")) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.name), default=None)
    if best:
        return host, path, best.name, best.verdict
    blocked = any(re.search(p.expression, (url or "").lower()) for p in url_filter.PATTERNS)
    return host, path, None, "block" if blocked else "allow"


def test_urls_equal_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in URLS], "page_id BIGINT, url STRING, host STRING, tokens INT")
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, HOST_RULES).collect())
    assert got == Counter((i, *brute_url(u)) for i, u in URLS)
    assert url_filter.judge(pages.limit(0), HOST_RULES).collect() == []
    assert {r.verdict for r in url_filter.judge(pages, [], ()).collect()} == {"allow"}


def test_rules_without_tokens_and_blocks_of_rules(spark, monkeypatch):
    rows = [(1, "http://пример.рф/a"), (2, "http://a.пример.рф/b"), (3, "http://рф/"), (4, None), (5, "x://shop.org/fr/ads/x")]
    rows += [(10 + k, "http://hot.net/x") for k in range(200)] + [(300 + k, None) for k in range(100)]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING")
    hosts = [*HOST_RULES, url_filter.HostRule("пример.рф", "/", "block"), url_filter.HostRule("пример.рф", "/b", "allow")]
    want = {1: ("пример.рф/", "block"), 2: ("пример.рф/b", "allow"), 3: (None, "allow"), 4: (None, "allow"), 5: ("org/fr/", "allow")}
    want |= {10 + k: ("net/", "block") for k in range(200)} | {300 + k: (None, "allow") for k in range(100)}
    for size in (url_filter.RULES, 3):
        monkeypatch.setattr(url_filter, "RULES", size)
        got = [(r.page_id, (r.rule, r.verdict)) for r in url_filter.judge(pages, hosts).collect()]
        assert len(got) == len(rows) and dict(got) == want


def test_rules_are_fetched_by_their_rarest_token():
    rule = url_filter.HostRule("example.net", "/en/", "allow")
    assert sorted(rule.tokens) == ["en", "example", "net"]
    assert url_filter.index([rule], {"example": 9, "net": 5, "en": 2}) == [(0, "en")]


# ---- pages ----

PAGE = (
    "<html><head><title>t</title><style>p{{}}</style></head><body><nav><a href='/'>Home</a></nav><div class='ad'>buy</div>"
    "<article><h1>Head {n}</h1><p>First &amp; <b>bold</b>  text {n}<p>Same on all pages<br>line</article>"
    "<div class='comments'><p>nice {n}</p></div><footer>f {n}</footer><script>var a='</p>';</script></body></html>"
)


def test_main_text(spark):
    rows = [(n, f"http://h{n % 2}.org/{n}", PAGE.format(n=n)) for n in range(12)]
    rows += [
        (20, None, None), (21, "http://h0.org", ""), (22, "http://solo.org", "<p>only</p><aside>x</aside>"),
        (23, "http://h1.org", "<article><p>cut &lt off</p><p>here &am"), (23, "http://h1.org", "<article><p>cut &lt off</p><p>here &am"),
        (24, "http://h1.org", "<html><body><article><p>a</p><form>f</form><!-- c --><p>b</p></article> tail <nav"),
    ]
    pages = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id BIGINT, url STRING, html STRING, host STRING, container INT")
    got = defaultdict(list)
    for r in html_template.main_texts(pages).collect():
        got[r.page_id].append(r.text)
    for n in range(12):
        assert got[n] == [f"Head {n}\n\nFirst & bold text {n}\n\nSame on all pages line"]
    assert got[20] == [""] and got[21] == [""] and got[22] == ["only"]
    assert got[23] == ["cut < off\n\nhere &am"] * 2
    assert got[24] == ["a\n\nb"]
    assert html_template.main_texts(pages.limit(0)).collect() == []


def texts_of(spark, rows):
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
    return {r.page_id: r.text for r in html_template.main_texts(pages).collect()}


@pytest.mark.parametrize(("body", "wrap"), [
    ("body class='single no-sidebar'", "article class='post comments-open'"),
    ("body class='search'", "div class='content with-sidebar'"), ("body", "main class='social'"),
])
def test_names_of_other_things_drop_no_article(spark, body, wrap):
    page = (
        "<html><{0}><div class='cookie-banner'>we bake {2}</div><{1}><h1>Head {2}</h1><p>a text of its own {2}</p></{3}>"
        "<div class='comment-list'><p>nice {2}</p></div></body></html>"
    )
    got = texts_of(spark, [(n, f"http://a.org/{n}", page.format(body, wrap, n, wrap.split()[0])) for n in range(6)])
    assert got == {n: f"Head {n}\n\na text of its own {n}" for n in range(6)}


def slug(n):
    return "".join(chr(97 + int(c)) for c in str(n))


@pytest.mark.parametrize("pages", [12, 1200])
def test_articles_under_paths_of_their_own(spark, pages):
    page = "<html><body><div class='teaser'>read on {0}</div><div id='post-{1}'><p>an article of its own {0}, much longer</p></div></body></html>"
    got = texts_of(spark, [(n, f"http://a.org/{n}", page.format(n, slug(n))) for n in range(pages)])
    assert all(f"an article of its own {n}, much longer" in got[n] for n in range(pages))


def test_template_overrules_a_name_around_the_container(spark):
    page = (
        "<html><body><div class='top'>hello {0}</div><div class='layout sidebar'><div class='w-1/2'><p>an article of its own {0}, "
        "much longer</p></div></div></body></html>"
    )
    got = texts_of(spark, [(n, f"http://a.org/{n}", page.format(n)) for n in range(6)])
    assert got == {n: f"an article of its own {n}, much longer" for n in range(6)}


def test_texts_of_the_template_are_no_article(spark):
    page = (
        "<html><body><article><h1>Head {0}</h1><div class='x1'>Sign up <b>now</b></div><p>first text {0}</p>"
        "<p>A paragraph that all repeat</p><div class='q'>{1}</div></article></body></html>"
    )
    rows = [(n, f"http://a.org/{n}", page.format(n, "All rights kept" if n else "Once told")) for n in range(24)]
    rows += [(100 + n, f"http://copies.org/{n}", page.format(0, "All rights kept")) for n in range(4)]
    got = texts_of(spark, rows)
    for n in range(1, 24):
        assert got[n] == f"Head {n}\n\nfirst text {n}\n\nA paragraph that all repeat"
    assert got[0] == "Head 0\n\nfirst text 0\n\nA paragraph that all repeat\n\nOnce told"
    copy = "Head 0\n\nSign up now\n\nfirst text 0\n\nA paragraph that all repeat\n\nAll rights kept"
    assert [got[100 + n] for n in range(4)] == [copy] * 4


def test_repeated_paragraphs_and_headings_are_kept(spark):
    body = "".join(f"<p>paragraph {k} of a text that three pages have</p>" for k in range(12))
    page = "<html><body><div class='post'><h1>Title {0}</h1><{1}>{2}</{1}><div>updated {0}</div></div></body></html>"
    own = "".join(f"<p>another paragraph {k}</p>" for k in range(12))
    rows = [(n, f"http://near.org/{n}", page.format(n, "section", body if n else own)) for n in range(4)]
    # plain divisions instead of paragraphs: too much of the page to be a template's
    rows += [(10 + n, f"http://plain.org/{n}", page.format(n, "section", (body if n else own).replace("p>", "div>"))) for n in range(4)]
    parts = (
        "<html><body><article><h1>Head {0}</h1><h2>Introduction</h2><p>first {0}</p><ul><li>Same item</ul><h2>Conclusion</h2>"
        "<p>last {0}</p><div class='x'>Sign up now</div></article></body></html>"
    )
    rows += [(20 + n, f"http://heads.org/{n}", parts.format(n)) for n in range(6)]
    got = texts_of(spark, rows)
    for n in range(1, 4):
        for first in (0, 10):
            lines = got[first + n].split("\n\n")
            assert lines[:13] == [f"Title {n}", *(f"paragraph {k} of a text that three pages have" for k in range(12))]
    for n in range(6):
        assert got[20 + n] == "\n\n".join([f"Head {n}", "Introduction", f"first {n}", "Same item", "Conclusion", f"last {n}"])


def test_main_text_of_given_pages(spark):
    rows = CORPUS_QUERIES["op6_html_extraction"](spark, SMALL).collect()
    source = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in rows:
        inner = re.search(r"(?s)<article>(.*?)(</article>|$)", source[r.page_id])[1]
        blocks = [re.sub(r"<[^>]*>", " ", b.replace("<b>", "").replace("</b>", "")) for b in re.split(r"</?(?:p|h1)>", inner)]
        blocks = [" ".join(html.unescape(b).split()) for b in blocks]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_crossing_classes_are_invalid():
    import pandas as pd

    def token(name, f, position, chars=0, pages=4):
        return dict(token=name, pages=pages, total=pages, position=position * pages, f1=f, f2=f, chars=chars)

    rows = [
        token("</body", 1, 1), token(">/body", 1, 9), token("</body/div", 2, 3, 500), token(">/body/div", 2, 6),
        token("</body/nav", 3, 4, 0, 3), token(">/body/nav", 3, 8, 0, 3),
    ]
    assert html_template.template(pd.DataFrame(rows), 4) == "/body/div"


# ---- shards ----


def check_shards(rows, shards):
    assert all(0 <= r.shard < shards for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_a_hot_text(documents):
    rows = [(i, "the same text " * 20) for i in range(3000)] + [(5000 + i, f"t{i} " * (i % 50)) for i in range(3000)]
    got = sharding.shard(documents(rows), 8).collect()
    assert len(got) == len(rows)
    check_shards(got, 8)
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    total = sum(sizes.values())
    assert len(sizes) == 8 and all(abs(s - total / 8) <= 400 + 0.003 * total / 8 for s in sizes.values())


def test_shards_of_odd_texts(documents, odd_texts):
    got = sharding.shard(documents(odd_texts), 4).collect()
    check_shards(got, 4)
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in odd_texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert sharding.shard(documents([]), 4).collect() == []


def test_splitters_equal_a_full_sort(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    rows = sharding.keyed(docs)
    keys = sorted((r.h, r.i, r.size) for r in rows.collect())
    total, largest = sum(k[2] for k in keys), max(k[2] for k in keys)
    for k, first in enumerate(sharding.splitters(rows, 10), 1):
        below = sum(size for h, i, size in keys if (h, i) < first)
        assert abs(below - total * k / 10) <= max(largest / 2, sharding.TOLERANCE * total / 10)


def test_sharding_is_native(spark):
    plan = CORPUS_QUERIES["op10_sharding"](spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- SQL ----


@pytest.mark.parametrize("name", sorted(CORPUS_ORACLES))
def test_query_matches_oracle(spark, name):
    from oracle_check import connect, differences

    assert differences(CORPUS_QUERIES[name](spark, SMALL), connect(SMALL), CORPUS_ORACLES[name]) == []
