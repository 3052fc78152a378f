"""Toxicity: a weighted finite-state grammar over clauses, its weights learned from labels.

Words become classes (insult, threat verb, modal, target, negation, report, other).
Small transducers rewrite the class sequence of a clause, one composed with the next: the
negation transducer marks the words in a negation's scope, the report transducer those
after a verb of saying, the target transducer those in a clause that addresses someone before
them (and, run from the clause's end, after them), and the threat transducer lets a threat verb
through only after a modal. The insult transducer runs over what the clauses of a document give:
an insult without a target is held back until another follows, so that a text's one isolated
word comes out as ``single``, which weighs little, and repeated ones as ``repeated``. What
comes out are scored matches; a document's score is a logistic function of its strongest and its
summed matches of each kind. Weights are learned from the labels, near prior ones that hold where labels
have no contrast: negated and reported matches weigh less than single ones.

Insult words are the fixed ones and learned ones: word beginnings and whole words that labelled toxic texts
have and clean ones lack. Learning uses at most ``TOXIC`` and ``CLEAN`` labelled rows, taken in
order of a hash of their ids, one of each set of near copies; counting runs in Spark, and
the driver gets only entries that pass the test, and one row of sums per sampled text.

Defined results: null and empty texts score as a text without matches; repeated rows
score alike; without usable labels the prior weights and the fixed words stand; rows of
``labels`` with nulls teach nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import fold, stored

#: Function words and threat words of four languages.
INSULTS = (
    "idiot moron stupid scum loser pathetic worthless disgusting trash clown "
    "dummkopf arschloch trottel abschaum connard salaud imbécile ordure imbécil estúpido escoria"
)
THREATS = (
    "kill hurt destroy beat shoot stab burn töten umbringen schlagen vernichten "
    "tuer frapper détruire brûler matar golpear destruir quemar"
)
MODALS = "will shall gonna going should must werde wird sollte muss vais va doit voy debe"
TARGETS = (
    "you your yourself he him she her they them du dich dein sie ihr euch "
    "tu toi vous ton il elle eux tú usted ustedes él ella"
)
NEGATIONS = "not no never neither nor nicht kein keine nie pas jamais aucun nunca ningún"
REPORTS = (
    "said says say called calls claimed claims wrote quoted sagte sagt nannte behauptet "
    "dit disait appelle prétend dijo dice llamó afirma"
)

TOXIC, CLEAN = 3_000, 9_000
ENTRIES = 5_000  # learned words at most, the best supported
EVIDENCE = 24.0  # log-likelihood ratio that an entry needs
PRECISION = 0.8  # share of toxic texts among those that have it, weighted to equal class sizes
SCALE = 6.0  # log odds of a word with weight 1
SHRINKAGE = 2.0  # texts for which a beginning's precision counts in that of a word

WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[.;:!?\n\r]+")

# ---- transducers ----
# A transducer is a start state and a function (state, symbol) -> (state, symbol).
# Symbols are (class, marks), marks a frozenset.


def negation(state: int, symbol):
    """Marks insults and threats up to four words after a negation."""
    kind, marks = symbol
    if kind == "negation":
        return 4, symbol
    if state and kind in ("insult", "threat"):
        return state - 1, (kind, marks | {"negated"})
    return max(0, state - 1), symbol


def report(state: int, symbol):
    """Marks insults and threats after a verb of saying, to the end of the clause."""
    kind, marks = symbol
    if kind == "report":
        return 1, symbol
    if state and kind in ("insult", "threat"):
        return state, (kind, marks | {"reported"})
    return state, symbol


def target(state: int, symbol):
    """Marks insults and threats with someone addressed before them."""
    kind, marks = symbol
    if kind == "target":
        return 1, symbol
    if state and kind in ("insult", "threat"):
        return state, (kind, marks | {"targeted"})
    return state, symbol


def insult(state: tuple, match):
    """Over a document: holds the first insult without a target, and gives it as repeated when a second comes.

    Gives a list of matches (kind, weight); what is held at the end is a single one.
    """
    kind, weight = match
    if kind != "insult":
        return state, [match]
    if state is None:
        return (weight,), []
    return (), [("repeated", w) for w in (*state, weight)]


def threat(state: int, symbol):
    """Lets a threat verb pass up to four words after a modal; others are plain words."""
    kind, marks = symbol
    if kind == "modal":
        return 4, symbol
    if kind == "threat" and not state:
        return 0, ("other", marks)
    return max(0, state - 1), symbol


def compose(*transducers):
    """One transducer that feeds each one's output to the next; its state is the tuple of theirs."""

    def step(state, symbol):
        after = []
        for own, transducer in zip(state, transducers):
            own, symbol = transducer(own, symbol)
            after.append(own)
        return tuple(after), symbol

    return (0,) * len(transducers), step


START, STEP = compose(threat, negation, report, target)
KINDS = ("single", "repeated", "targeted", "negated", "reported", "threat")
#: Prior means of the logistic weights: intercept, then strongest and summed match of each kind.
PRIOR = np.array([-4.0, 2.0, 5.0, 6.0, 1.0, 1.0, 5.0, 0.2, 0.5, 0.5, 0.1, 0.1, 0.5])


@dataclass
class Grammar:
    """The insult entries with their weights, and the logistic weights of match kinds."""

    entries: dict[str, float]  # a whole word ends in "$", else it is a word's beginning
    weights: np.ndarray

    @cached_property
    def classes(self) -> dict[str, str]:
        lists = (
            ("report", REPORTS), ("target", TARGETS), ("negation", NEGATIONS), ("modal", MODALS), ("threat", THREATS)
        )
        return {w: kind for kind, ws in lists for w in ws.split()}

    @cached_property
    def trigger(self) -> re.Pattern:
        """Finds the words that can make a clause match."""
        words = [re.escape(e[:-1]) + r"(?![^\W\d_])" if e.endswith("$") else re.escape(e) for e in self.entries]
        words += [re.escape(w) + r"(?![^\W\d_])" for w in THREATS.split()]
        # by first letter: most places need a look at one branch each only
        rest: dict[str, list[str]] = {}
        for word in sorted(words):
            rest.setdefault(word[0], []).append(word[1:])
        return re.compile(rf"(?<![^\W\d_])(?:{'|'.join(f'{c}(?:{"|".join(own)})' for c, own in rest.items())})")

    @cached_property
    def lengths(self) -> list[int]:
        return sorted({len(e) for e in self.entries if not e.endswith("$")})

    def classify(self, word: str) -> tuple[str, float]:
        weight = self.entries.get(f"{word}$")
        if weight is None:
            weight = max((self.entries.get(word[:n], 0.0) for n in self.lengths if n <= len(word)), default=0.0)
        if weight:
            return "insult", weight
        return self.classes.get(word, "other"), 1.0

    def clause(self, words: list[str]) -> list[tuple[str, float]]:
        """The scored matches of a clause: (kind, weight)."""
        state, symbols, weights = START, [], []
        for word in words:
            kind, weight = self.classify(word)
            state, symbol = STEP(state, (kind, frozenset()))
            symbols.append(symbol)
            weights.append(weight)
        back = 0
        for k in range(len(symbols) - 1, -1, -1):
            back, symbols[k] = target(back, symbols[k])
        return [
            (
                "negated" if "negated" in marks
                else "reported" if "reported" in marks
                else "threat" if kind == "threat"
                else "targeted" if "targeted" in marks
                else "insult",
                weight,
            )
            for (kind, marks), weight in zip(symbols, weights) if kind in ("insult", "threat")
        ]

    def matches(self, lower: str) -> Iterator[tuple[str, float]]:
        """The scored matches of a text in lower case: (kind, weight)."""
        held = None
        for part in CLAUSE.split(lower):
            if self.trigger.search(part):
                for match in self.clause(WORD.findall(part)):
                    held, given = insult(held, match)
                    yield from given
        for weight in held or ():
            yield "single", weight

    def features(self, text: str | None) -> np.ndarray:
        """Intercept, then the strongest and the (damped) sum of clause matches by kind."""
        out = np.zeros(1 + 2 * len(KINDS))
        out[0] = 1.0
        lower = (text or "").lower()
        if not self.trigger.search(lower):
            return out
        sums = dict.fromkeys(KINDS, 0.0)
        for kind, weight in self.matches(lower):
            k = 1 + KINDS.index(kind)
            out[k] = max(out[k], weight)
            sums[kind] += weight
        out[1 + len(KINDS) :] = [math.log1p(s) for s in sums.values()]
        return out

    def score(self, text: str | None) -> float:
        return float(1 / (1 + math.exp(-min(30.0, max(-30.0, self.features(text) @ self.weights)))))


def prior() -> Grammar:
    return Grammar({f"{w}$": 1.0 for w in INSULTS.split()}, PRIOR)


# ---- learning ----


def near_copy_key(text: str) -> str:
    """Equal for most near copies: the smallest hash of the text's eight-word shingles."""
    words = text.lower().split()
    grams = {" ".join(words[i : i + 8]) for i in range(max(1, len(words) - 7))}
    return min(hashlib.blake2b(g.encode(), digest_size=8).hexdigest() for g in grams)


def parts_of(text: str) -> set[str]:
    """The whole words ("word$") and word beginnings of three to eight letters of a text."""
    out = set()
    for word in set(WORD.findall(text.lower())):
        out.add(f"{word}$")
        out.update(word[:n] for n in range(3, min(8, len(word)) + 1))
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, folds: int, held: int) -> DataFrame:
    """At most TOXIC + CLEAN labelled texts outside the held-out fold, one per set of near copies."""
    known = labels.filter(fold("doc_id", folds) != held).select(F.col("doc_id").alias("label_id"), "toxic").distinct()
    chosen = None
    for value, most in ((1, TOXIC), (0, CLEAN)):
        part = known.filter(F.col("toxic") == value).orderBy(F.xxhash64("label_id"), "label_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    key = F.udf(near_copy_key, "string", useArrow=True)
    sample = docs.select("doc_id", "text").filter("text IS NOT NULL").join(
        F.broadcast(chosen), F.col("doc_id") == F.col("label_id")
    )
    sample = stored(sample.select("doc_id", "text", "toxic", key("text").alias("copy")), "toxicity-sample")
    firsts = sample.groupBy("copy", "toxic").agg(F.min("doc_id").alias("first"))
    return stored(
        sample.alias("s").join(F.broadcast(firsts.alias("f")), F.expr("s.copy = f.copy AND s.toxic = f.toxic AND doc_id = first"))
        .select("text", F.col("s.toxic").alias("toxic")),
        "toxicity-sample",
    )


def learned_entries(sample: DataFrame) -> dict[str, float]:
    """Word beginnings and words that tell toxic from clean texts, with weights up to 1."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 300):
                part = batch.slice(start, 300)
                toxic, clean = Counter(), Counter()
                for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    (toxic if label else clean).update(parts_of(text))
                keys = list(toxic | clean)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.string()),
                        pa.array([toxic[k] for k in keys], pa.int64()),
                        pa.array([clean[k] for k in keys], pa.int64()),
                    ],
                    ["part", "toxic", "clean"],
                )

    totals = sample.agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).first()
    t_all, c_all = int(totals["t"] or 0), int(totals["c"] or 0)
    if not t_all or not c_all:
        return {}
    counts = sample.select("text", "toxic").mapInArrow(count, "part STRING, toxic BIGINT, clean BIGINT")
    counts = counts.groupBy("part").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    share = F.lit(t_all / (t_all + c_all))
    n = F.col("t") + F.col("c")
    evidence = 2 * (
        F.col("t") * F.log(F.col("t") / (n * share))
        + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (n * (1 - share)))).otherwise(0.0)
    )
    precision = (F.col("t") / t_all) / (F.col("t") / t_all + F.col("c") / c_all)
    good = counts.filter("t > 2").filter((evidence >= EVIDENCE) & (precision >= PRECISION))
    rows = good.orderBy(F.desc("t"), "part").limit(ENTRIES).collect()
    support = {r["part"]: r["t"] for r in rows}
    clean = {r["part"]: r["c"] for r in rows}
    kept: dict[str, float] = {}
    for entry in sorted(support, key=lambda e: (len(e), e)):
        # as long as nearly all texts stay, a longer beginning says it more exactly
        while longer := next(
            (e for e in support if e != entry and not entry.endswith("$") and e.startswith(entry)
             and len(e) <= len(entry) + 1 and support[e] >= 0.98 * support[entry]),
            None,
        ):
            entry = longer
        whole = max((e for e in support if e.endswith("$") and e.startswith(entry)), key=support.get, default=None)
        if whole and support[whole] >= 0.98 * support[entry]:
            entry = whole
        if not any(entry.startswith(k) for k in kept if not k.endswith("$")):
            kept[entry] = log_odds(support[entry] / t_all, clean[entry] / c_all, 0.5 / c_all)
    # words under a kept beginning have weights of their own, near that of the beginning
    begins = [k for k in kept if not k.endswith("$")]
    if begins:
        known = counts.filter(F.col("part").endswith("$") & F.substring("part", 1, 3).isin([b[:3] for b in begins]))
        for row in known.orderBy(F.desc(F.col("t") + F.col("c")), "part").limit(ENTRIES).collect():
            begin = max((b for b in begins if row["part"].startswith(b)), key=len, default=None)
            if begin is not None:
                t, c = row["t"] / t_all, row["c"] / c_all
                prior = SHRINKAGE / (t_all + c_all)
                odds = math.exp(kept[begin] * SCALE)
                kept[row["part"]] = log_odds(t + prior * odds / (1 + odds), c + prior / (1 + odds), 0.0)
    return kept


def log_odds(toxic: float, clean: float, doubt: float) -> float:
    """A weight from 0 (as likely in clean texts) to 1."""
    return round(min(1.0, max(0.0, math.log((toxic + 1e-9) / (clean + doubt + 1e-9)) / SCALE)), 4)


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> Grammar:
    """The grammar learned from labelled rows whose fold is not ``held``."""
    sample = labelled_sample(docs, labels, folds, held)
    entries = learned_entries(sample)
    grammar = Grammar({**prior().entries, **entries}, PRIOR)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [grammar.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tolist() for r in rows], pa.list_(pa.float64())), batch.column(1)], ["x", "toxic"]
            )

    rows = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        measure, "x ARRAY<DOUBLE>, toxic INT"
    ).collect()
    return Grammar(grammar.entries, logistic(rows) if rows else PRIOR)


def logistic(rows: list) -> np.ndarray:
    """Logistic weights near the prior ones; no match kind speaks for a clean text."""
    x = np.array([r["x"] for r in rows])
    y = np.array([r["toxic"] for r in rows], float)
    w, precision = PRIOR.copy(), 1.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + precision * (w - PRIOR)
        curvature = (x * (p * (1 - p))[:, None]).T @ x + precision * np.eye(len(w))
        step = np.linalg.solve(curvature, gradient)
        w = w - step
        w[1:] = np.maximum(w[1:], 0.0)
        if np.abs(step).max() < 1e-6:
            break
    return w


def score(grammar: Grammar) -> Column:
    """The score of column ``text``, 0 to 1."""
    plain = grammar.entries, grammar.weights

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Grammar(*plain)
        for texts in batches:
            yield pd.Series([own.score(t if isinstance(t, str) else None) for t in texts], dtype="float64")

    return run(F.col("text"))


def without_toxic(docs: DataFrame, grammar: Grammar, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``."""
    return docs.filter(score(grammar) < limit)
