"""Main text of web pages by equivalence-class template deduction.

Pages of one host come from few templates. A page is a sequence of tokens: opening and
closing tags and texts, told apart by the path of elements they stand in. A text is one
token with all its words, from one break to the next. The occurrence vector of
a token counts it on every page of the host; tokens with equal vectors form an
equivalence class. Vectors are compared by fingerprints, sums over pages of a page's hash
times the token's count, so a host of any size is reduced by partial sums before the
shuffle, and no task holds its pages. Classes that are large (two tokens or more) and
frequent (on half of the host's pages) are taken in order of support; one that would
cross a class already taken, instead of nesting in one of its slots, is invalid. What is
left is the host's template, and the text between its tokens lies in its slots. The
element whose slots hold the article is the innermost container with the article's main
heading, if pages have one of their own, and most of the host's text outside of navigation, notices, adverts, forms and comments; the text of its slots
is extracted page by page. A text that half of the host's pages have in one path belongs to
the template, unless that path has other texts too on more than a few pages: then it is a
slot. Headings and paragraphs (``PARAGRAPHS``) always are: articles repeat them, and pages of a
host may be near copies of each other. For the same reason a page that would lose more than
half of its container's text keeps all of it. Tables of tokens that all hosts share serve pages whose host
has too few pages, or that lack their host's container.

Defined results: null, empty and markup-free pages give the text outside of any markup,
mostly none; a null or odd URL belongs to the host ``''``; equal rows give equal texts;
an empty table gives none; other columns are ignored. Nothing but the named parts of a
page and the texts of its host's template is dropped; repeated paragraphs are kept. Unclosed comments, scripts and tags run to
the end of the page.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections import defaultdict
from collections.abc import Collection, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import small_side, stored
from weirflow.llm.url_filter import host_and_path

FREQUENT = 0.5  # share of a host's pages that a class of its template is on
LEAST_PAGES = 3  # of a host with a template of its own
OTHER_TEXTS = 0.1  # in a path of template texts: other texts for each of these, at most
MOST_TEXT = 0.6  # share of the text outside of dropped parts that the container holds
ALL = "*"

TAG = re.compile(
    r"""(?s)<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^"'>])*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)"""
)
NAMES = re.compile(r"""(?i)\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")

#: Fixed values of HTML: elements without content, whose text is no text, that flow within a line, that close each other.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup "
    "time tt u var".split()
)
#: Texts in these are slots, never part of a template.
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption caption td th".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption caption td th tr ul ol dl".split())
CLOSED_BY_BLOCK = frozenset({"p"})
SAME_CLOSES = frozenset("li dt dd tr td th option".split())
#: Parts that are no article: by element, and by class, id and role.
DROPPED = frozenset(
    "head nav header footer aside form button select fieldset dialog menu object canvas audio video".split()
) | RAW
COMMENT_WORDS = frozenset("comment comments reply replies disqus respond".split())
DROPPED_WORDS = COMMENT_WORDS | frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "notice notices alert gdpr nav navbar navigation menu breadcrumb breadcrumbs sidebar side footer header masthead "
    "share sharing social related recommended newsletter subscribe "
    "signup login popup modal overlay widget toolbar pagination pager search skip".split()
)
#: Words that may stand beside those in the name of a part (``comment-list``); any other makes it another name.
PART_WORDS = frozenset("area bar block box container list site thread wrap wrapper".split())
#: Elements that names never drop.
HOLDERS = frozenset("html body main article".split())
KEPT, BY_NAME, COMMENTS, BY_ELEMENT = range(4)


def _level(name: str, attributes: str) -> int:
    """How an element is dropped: not, by a name of other parts or of comments, or as an element of its kind.

    Only a whole class, id or role names a part: ``no-sidebar`` or ``comments-open`` tell something else.
    """
    if name in DROPPED:
        return BY_ELEMENT
    if "=" not in attributes or name in HOLDERS:
        return KEPT
    level = KEPT
    for match in NAMES.finditer(attributes):
        for token in (match[1] or match[2] or match[3] or "").lower().split():
            named = set(re.findall(r"[a-z]+", token)) - PART_WORDS
            if named and named <= DROPPED_WORDS:
                level = max(level, COMMENTS if named <= COMMENT_WORDS else BY_NAME)
    return level


def _label(name: str, attributes: str) -> str:
    """An element's name with its classes: what tells equal elements of a template apart."""
    found = NAMES.search(attributes) if "=" in attributes else None
    value = " ".join((found[1] or found[2] or found[3] or "").split()) if found else ""
    # numbered names are one name; a slash would be a step of the path
    return f"{name}.{re.sub(r'[0-9]+', '0', value).replace('/', '|')}" if value else name


def events(page: str, spared: str = "") -> Iterator[tuple[str, str, int]]:
    """("open" | "close", path, level), ("text", text, level) and ("break", "", level) events of a page.

    ``level`` tells how the elements around drop the place; names of the element with the path
    ``spared`` and of those around it do not count. Inline elements and void ones are no part of the path.
    """
    stack: list[tuple[str, str, int]] = []  # name, path, level
    at, raw = 0, None

    def level() -> int:
        return stack[-1][2] if stack else KEPT

    for tag in TAG.finditer(page):
        name = (tag[2] or "").lower()
        if raw:  # only its own closing tag ends the content of a raw element
            if not (tag[1] and name == raw):
                continue
            at = tag.start()
        elif tag.start() > at:
            yield "text", page[at : tag.start()], level()
        at, raw = tag.end(), None
        if not name:
            continue
        if not tag[1]:
            if name == "br":
                yield "text", " ", level()
            elif name in VOID:
                yield "break", "", level()
            elif name not in INLINE:
                yield "break", "", level()
                if name in SAME_CLOSES and stack and stack[-1][0] == name or (
                    stack and stack[-1][0] in CLOSED_BY_BLOCK
                ):
                    yield "close", stack.pop()[1], level()
                path = f"{stack[-1][1] if stack else ''}/{_label(name, tag[3])}"
                own = _level(name, tag[3])
                if own < BY_ELEMENT and f"{spared}/".startswith(f"{path}/"):
                    own = KEPT
                stack.append((name, path, max(level(), own)))
                yield "open", path, stack[-1][2]
                if name in RAW:
                    raw = name
        elif name not in INLINE and name not in VOID:
            yield "break", "", level()
            if any(s[0] == name for s in stack):
                while True:
                    closed = stack.pop()
                    yield "close", closed[1], level()
                    if closed[0] == name:
                        break
    if not raw and at < len(page):
        yield "text", page[at:], level()


def blocks(page: str, spared: str = "") -> Iterator[tuple[str, str, str, int]]:
    """("open" | "close", path, "", level) and ("block", path, text, level) events: texts between breaks, unescaped."""
    current: list[str] = []
    stack, at = [""], KEPT
    for kind, value, level in events(page, spared):
        if kind == "text":
            current.append(value)
            at = level
            continue
        if current:
            if text := " ".join(html.unescape("".join(current)).split()):
                yield "block", stack[-1], text, at
            current.clear()
        if kind == "open":
            stack.append(value)
            yield kind, value, "", level
        elif kind == "close":
            stack.pop()
            yield kind, value, "", level
    if text := " ".join(html.unescape("".join(current)).split()):
        yield "block", stack[-1], text, at


def is_paragraph(path: str) -> bool:
    """Whether a text in this path stands in a heading or paragraph."""
    return path.rpartition("/")[2].partition(".")[0] in PARAGRAPHS


def text_hash(path: str, text: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{path}\n{text}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def tokens_of(page: str) -> dict[str, list[int]]:
    """By token of a page its count, summed positions, length of the text in its path and below, and texts in its path.

    The length is given twice: of kept text, and with the text that only names (but not those
    of comments) drop. Tokens of texts are ``=``, their hash and their path; ``""`` stands for the whole page.
    """
    tokens: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0, 0])
    own: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    position = 0
    for kind, path, text, level in blocks(page):
        if kind != "block":
            position += 1
            row = tokens[("<" if kind == "open" else ">") + path]
            row[0] += 1
            row[1] += position
        elif level <= BY_NAME:
            own[path][0] += len(text) if level == KEPT else 0
            own[path][1] += len(text)
            row = tokens[f"={text_hash(path, text)} {path}"]
            row[0] += 1
            row[1] += position
            row[2] += len(text) if level == KEPT else 0
            row[3] += len(text)
            if path:
                tokens["<" + path][4] += 1
    for path, (kept, loose) in own.items():
        while True:
            row = tokens["<" + path if path else ""]
            row[2] += kept
            row[3] += loose
            if not path:
                break
            path = path.rpartition("/")[0]
    return tokens


def template(
    tokens: pd.DataFrame, pages: int, whole: int | None = None, repeated: Collection[str] | None = None
) -> str | None:
    """The path of the element that holds the article, from a host's frequent tokens and its length of text.

    ``chars`` of a token is the text in its path and below, on all pages; ``repeated`` are the paths
    that have a text of many pages: a main heading in another path is an article's and belongs to it.
    """
    classes = defaultdict(list)
    tokens = tokens[~tokens.token.str.startswith("=")]
    for row in tokens.itertuples(index=False):
        classes[row.f1, row.f2].append(row)
    taken: list[list] = []
    spans: list[tuple[float, float]] = []
    for rows in sorted(classes.values(), key=lambda rows: (-rows[0].pages, -len(rows), rows[0].token)):
        if len(rows) < 2 or rows[0].pages < FREQUENT * pages:
            continue
        rows.sort(key=lambda r: r.position / r.total)
        low, high = (rows[k].position / rows[k].total for k in (0, -1))
        if any(a < low <= b < high or low < a <= high < b for a, b in spans):
            continue  # crosses a class already taken
        taken.append(rows)
        spans.append((low, high))
    chars: dict[str, int] = defaultdict(int)
    for rows in taken:
        for r in rows:
            chars[r.token[1:]] += r.chars
    whole = max(chars.values(), default=0) if whole is None else whole
    if not whole:
        return None

    def name(path: str) -> str:
        return path.rpartition("/")[2].partition(".")[0]

    holders = [
        p for p, n in chars.items() if n >= MOST_TEXT * whole and name(p) not in LEAVES and name(p) not in DROPPED
    ]
    named = [p for p in holders if name(p) in ("article", "main")]
    if repeated is not None:
        titles = [p for p, n in chars.items() if n and name(p) == "h1" and p not in repeated]
        holders = [p for p in holders if any(t.startswith(f"{p}/") for t in titles)] or holders
    # the outermost article, else the innermost container
    return min(named, key=len) if named else max(holders, key=len, default=None)


def without_template_texts(tokens: pd.DataFrame) -> tuple[pd.DataFrame, list[int], int, int, int]:
    """A host's frequent tokens less its template's texts, the hashes of these, their two lengths, and what repeated paragraphs add to the second."""
    is_text = tokens.token.str.startswith("=")
    texts = tokens[is_text].assign(path=[token.partition(" ")[2] for token in tokens.token[is_text]])
    tokens = tokens[~is_text].copy()
    at = {token[1:]: k for k, token in enumerate(tokens.token) if token[0] == "<"}
    column = {c: tokens.columns.get_loc(c) for c in ("chars", "loose")}
    hashes, lengths, repeated = [], [0, 0], 0
    for path, own in texts.groupby("path"):
        if path not in at:
            continue  # outside of all elements
        if tokens.texts.iloc[at[path]] - own.total.sum() > OTHER_TEXTS * own.total.sum():
            continue  # a slot
        if is_paragraph(path):
            repeated += int(own["loose"].sum())
            continue
        hashes += [int(token.partition(" ")[0][1:]) for token in own.token]
        for k, name in enumerate(column):
            length = int(own[name].sum())
            lengths[k] += length
            around = path
            while around:
                if around in at:
                    tokens.iloc[at[around], column[name]] -= length
                around = around.rpartition("/")[0]
    return tokens, hashes, *lengths, repeated


SUMS = ("pages", "total", "position", "f1", "f2", "chars", "loose", "texts")
HELD = 50_000  # tokens that a task sums up before it sends them on


def deduce(pages: DataFrame) -> DataFrame:
    """Per host, and for all hosts as ``*``: the container's path and the template's texts; pages have page_id, host and html."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent() -> pa.RecordBatch:
            keys = list(sums)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                    *(pa.array([sums[k][c] for k in keys], pa.int64()) for c in range(len(SUMS))),
                ],
                ["host", "token", *SUMS],
            )

        for batch in batches:
            sums: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0] * len(SUMS))
            for page_id, host, page in zip(*(c.to_pylist() for c in batch.columns)):
                key = f"{page_id} {len(page or '')}".encode()
                h1, h2 = zlib.crc32(key), zlib.crc32(key[::-1], 77)
                for token, (n, position, chars, loose, texts) in {"": (0,) * 5, **tokens_of(page or "")}.items():
                    # texts are of one host's template only
                    for own in (host,) if token[:1] == "=" else (host, ALL):
                        row = sums[own, token]
                        row[0] += 1
                        row[1] += n
                        row[2] += position
                        row[3] += h1 * n
                        row[4] += h2 * n
                        row[5] += chars
                        row[6] += loose
                        row[7] += texts
                if len(sums) > HELD:
                    yield sent()
                    sums.clear()
            yield sent()

    schema = "host STRING, token STRING, " + ", ".join(f"{c} BIGINT" for c in SUMS)
    sums = pages.select("page_id", "host", "html").mapInArrow(collect, schema)
    hosts = pages.groupBy("host").agg(F.count("*").alias("host_pages")).filter(F.col("host_pages") >= LEAST_PAGES)
    hosts = stored(hosts.union(pages.agg(F.lit(ALL), F.count("*"))), "hosts")
    # rare tokens are in no template; their text is in the sums of the paths around them
    sums = sums.groupBy("host", "token").agg(*(F.sum(c).alias(c) for c in SUMS)).join(small_side(hosts), "host")
    frequent = stored(sums.filter((F.col("pages") >= FREQUENT * F.col("host_pages"))), "tokens")
    whole = frequent.filter("token = ''").select("host", F.col("chars").alias("host_chars"), F.col("loose").alias("host_loose"))
    frequent = frequent.filter("token <> ''").join(small_side(whole), "host")

    def one_host(rows: pd.DataFrame) -> pd.DataFrame:
        host, number, whole, loose = (rows[c].iloc[0] for c in ("host", "host_pages", "host_chars", "host_loose"))
        fixed = None if host == ALL else {t.partition(" ")[2] for t in rows.token if t.startswith("=")}
        left, hashes, kept, named, repeated = without_template_texts(rows)
        if loose > named + repeated:
            rows, whole, loose = left, whole - kept, loose - named
        else:  # the pages are copies of one page
            rows, hashes = rows[~rows.token.str.startswith("=")], []
        if whole < (1 - MOST_TEXT) * loose:  # most text stands below a name of other parts: its name tells something else
            rows, whole = rows.assign(chars=rows.loose), loose
        return pd.DataFrame({"host": [host], "container": [template(rows, int(number), int(whole), fixed)], "texts": [hashes]})

    found = frequent.groupBy("host").applyInPandas(one_host, "host STRING, container STRING, texts ARRAY<BIGINT>")
    return found.filter("container IS NOT NULL")


def extract(page: str | None, containers: list[str], texts: Collection[int] = ()) -> str:
    """The text blocks of the first container that the page has, else of the whole page, but for the template's texts."""
    own = list(blocks(page or ""))
    opened = {path: level for kind, path, _, level in own if kind == "open"}
    container = next((c for c in containers if c in opened), "")
    if opened.get(container):
        own = list(blocks(page or "", container))
    inside = [
        (path, text) for kind, path, text, level in own
        if kind == "block" and level == KEPT and f"{path}/".startswith(f"{container}/")
    ]
    if texts:
        slots = [(path, text) for path, text in inside if text_hash(path, text) not in texts]
        # most of the text is no template's: the page is a near copy of others
        if 2 * sum(len(text) for _, text in slots) >= sum(len(text) for _, text in inside):
            inside = slots
    return "\n\n".join(text for _, text in inside)


def main_texts(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url and the main text."""
    host, _ = host_and_path(F.coalesce("url", F.lit("")))
    known = pages.select("page_id", "url", "html", host.alias("host"))
    templates = stored(deduce(known), "templates")
    general = [r["container"] for r in templates.filter(F.col("host") == ALL).collect()]  # one row
    placed = known.join(small_side(templates.filter(F.col("host") != ALL)), "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                extract(page, [c for c in (container, *general) if c], frozenset(own or ()))
                for page, container, own in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return placed.select("page_id", "url", "html", "container", "texts").mapInArrow(
        run, f"page_id {kind}, url STRING, text STRING"
    )
