"""Secret scans over whole texts (native).

Base patterns give spans of assigned secrets, access keys and hex strings. The method adds
spans: long runs of key characters are candidates, and a window slides over each. Its
Shannon entropy is kept by incremental counts: a character that enters or leaves changes
one count, and with it one term of ``sum c log2 c``. So do the numbers of digits, upper and
lower case letters and characters that are no hex digits. A candidate is a secret if some
window of one character class (hex of one case, digits with letters of one case, or digits
with letters of both cases) reaches the entropy of that class. Candidates that are on the
allow list as a whole, windows that overlap an allowed part, and candidates that overlap a
base span, add nothing.

Positions are those of code points: the lengths of the pieces between matches and of the
matches, added up. Everything is a column expression of one row; nothing is shuffled.

Defined results: a null text has no spans; several kinds may cover the same place; equal
rows give equal results; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs are matched whole, so their least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_ASSIGNED = 6

WINDOW = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
HEX_BITS, ONE_CASE_BITS, MIXED_BITS = 3.0, 3.4, 3.6
#: Allow list, on whole candidates: UUIDs, numbers with marks, paths of words.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
    r"|^[0-9+/_=-]+$"
    r"|^/?([A-Za-z]+[0-9]{0,2}[/_=-])*[A-Za-z]+[0-9]{0,2}/?$"
)
#: Allow list, on parts of candidates: counting sequences, placeholders. What stands beside them is judged by itself.
ALLOWED_PARTS = (
    r"0123456789ABCDEF|0123456789abcdef|0123456789|1234567890|abcdefgh|ABCDEFGH|(?i:example|placeholder|changeme|x{6,})"
)

SPAN = "array<struct<start:int,kind:int,end:int>>"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def spans_of(text: Column, kind: int, pattern: str, keep=None, value_group: int = 0) -> Column:
    """The spans of a pattern's leftmost matches; ``keep(value)`` tells by a group's text whether a match counts."""
    empty = F.array().cast(SPAN)
    parts = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("values"),
        F.split(text, pattern, -1).alias("pieces"),
    )

    def fold(part: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            start = state["position"] + F.char_length(F.get(part["pieces"], i))
            end = start + F.char_length(F.get(part["matches"], i))
            span = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
            kept = span if keep is None else F.when(keep(F.get(part["values"], i)), span).otherwise(empty)
            return F.struct(end.alias("position"), F.concat(state["spans"], kept).alias("spans"))

        return F.aggregate(
            F.sequence(F.lit(0), F.size(part["matches"]) - 1),
            F.struct(F.lit(0).alias("position"), empty.alias("spans")),
            step,
            lambda state: state["spans"],
        )

    return F.when(text.rlike(pattern), let(parts, fold)).otherwise(empty)


def window_entropy(candidate: Column) -> Column:
    """The greatest window entropies of a candidate by class: struct (hex, one_case, mixed), -1 where no window is of the class."""

    def term(n: Column) -> Column:
        return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(0.0)

    def between(c: Column, low: str, high: str) -> Column:
        return ((c >= ord(low)) & (c <= ord(high))).cast("int")

    def step(state: Column, at: Column) -> Column:
        i, comes, goes = at["i"], at["comes"], at["goes"]
        more = F.get(state["counts"], comes)
        less = F.when(goes >= 0, F.get(state["counts"], goes)).otherwise(0)
        same = goes == comes
        change = F.when(same, 0.0).otherwise(term(more + 1) - term(more) + term(less - 1) - term(less))
        sum_now = state["sum"] + change
        counts = F.transform(
            state["counts"], lambda n, k: n + (k == comes).cast("int") - (k == goes).cast("int")
        )

        def kept(name: str, test) -> Column:
            return (state[name] + test(comes) - F.when(goes >= 0, test(goes)).otherwise(0)).alias(name)

        digits = kept("digits", lambda c: between(c, "0", "9"))
        upper = kept("upper", lambda c: between(c, "A", "Z"))
        lower = kept("lower", lambda c: between(c, "a", "z"))
        hexes = kept("hexes", lambda c: between(c, "0", "9") + between(c, "a", "f"))
        upper_hexes = kept("upper_hexes", lambda c: between(c, "0", "9") + between(c, "A", "F"))
        bits = F.lit(math.log2(WINDOW)) - sum_now / WINDOW
        full = i >= WINDOW - 1
        is_hex = full & ((hexes == WINDOW) | (upper_hexes == WINDOW)) & (digits >= 3) & (digits <= WINDOW - 3)
        is_one_case = full & ((digits + upper == WINDOW) | (digits + lower == WINDOW)) & (digits >= 2) & (digits <= WINDOW - 2)
        is_mixed = full & (digits >= 2) & (upper >= 2) & (lower >= 2)
        return F.struct(
            counts.alias("counts"), sum_now.alias("sum"), digits, upper, lower, hexes, upper_hexes,
            F.greatest(state["hex"], F.when(is_hex, bits).otherwise(-1.0)).alias("hex"),
            F.greatest(state["one_case"], F.when(is_one_case, bits).otherwise(-1.0)).alias("one_case"),
            F.greatest(state["mixed"], F.when(is_mixed, bits).otherwise(-1.0)).alias("mixed"),
        )

    zero = F.lit(0)
    start = F.struct(
        F.array_repeat(zero, 128).alias("counts"), F.lit(0.0).alias("sum"), zero.alias("digits"), zero.alias("upper"),
        zero.alias("lower"), zero.alias("hexes"), zero.alias("upper_hexes"), F.lit(-1.0).alias("hex"),
        F.lit(-1.0).alias("one_case"), F.lit(-1.0).alias("mixed"),
    )

    def slide(codes: Column) -> Column:
        # each step gets the character that enters and the one that leaves (-1: none yet)
        steps = F.transform(
            codes,
            lambda code, i: F.struct(
                i.alias("i"), code.alias("comes"),
                F.when(i >= WINDOW, F.get(codes, i - WINDOW)).otherwise(-1).alias("goes"),
            ),
        )
        return F.aggregate(
            steps, start, step, lambda state: F.struct(*(state[c].alias(c) for c in ("hex", "one_case", "mixed")))
        )

    # candidates are ASCII; the empty string at the end of the split is dropped
    return let(F.transform(F.filter(F.split(candidate, ""), lambda c: c != ""), F.ascii), slide)


def entropy_spans(text: Column, base: Column) -> Column:
    """Spans of the candidates with a window of high entropy, off the allow list and clear of base spans."""

    def hot(candidate: Column) -> Column:
        # a digit and a letter are in every window that counts
        plain = candidate.rlike("[0-9]") & candidate.rlike("[A-Za-z]") & ~candidate.rlike(ALLOWED)
        pieces = F.filter(F.split(candidate, ALLOWED_PARTS), lambda p: F.char_length(p) >= WINDOW)

        def reaches(piece: Column) -> Column:
            return let(
                window_entropy(piece),
                lambda best: (best["hex"] >= HEX_BITS) | (best["one_case"] >= ONE_CASE_BITS) | (best["mixed"] >= MIXED_BITS),
            )

        return F.when(plain, F.exists(pieces, reaches)).otherwise(False)

    found = spans_of(text, KINDS.index("entropy"), CANDIDATE, hot)
    return F.filter(
        found, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, base and spans, each an array of (start, kind, end) in order."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    base = F.concat(
        spans_of(text, 0, ASSIGN, lambda value: F.char_length(value) >= LEAST_ASSIGNED, value_group=2),
        spans_of(text, 1, ACCESS),
        spans_of(text, 2, HEX),
    )
    both = let(
        F.array_sort(base),
        lambda own: F.struct(
            own.alias("base"), F.array_sort(F.concat(own, entropy_spans(text, own))).alias("spans")
        ),
    )
    return texts.select("doc_id", both.alias("both")).select("doc_id", "both.base", "both.spans")
