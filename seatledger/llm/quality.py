"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule is a predicate over metrics of one text. The cascade measures on a
bounded sample what each rule costs and how much it rejects, orders the rules
by rejection per cost, and evaluates a rule only for rows that no earlier one
rejected. A row is kept if no rule rejects it, so the order
changes the cost and never the verdict.

Defined results: a null or empty text has no words and fails ``few_words``;
repeated rows are judged one by one; an empty table gives an empty one; extra
columns are carried by :func:`apply_cascade` and ignored by :func:`measure`.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, fresh, materialise, spaced, word_count, words_of

TEXT = "_sl_q_text"
SYMBOLS = "#*$%&|<>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it.

    A plain column would be put in its place by the optimizer, also inside lambdas.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _code_points_of(text: Column, chars: str) -> Column:
    bare = text
    for c in chars:
        bare = F.replace(bare, F.lit(c), F.lit(""))
    return (F.length(text) - F.length(bare)).cast("long")


def _repeat_words(words: Column) -> Column:
    """Words covered by a 3-word window that occurs again.

    Each window is a long: its hash above its start, which takes as many low bits
    as the text needs. Sorted, equal windows are neighbours; x ^ y of two of them
    has only low bits set. Where neighbours of equal hash bits have other words,
    the windows of that text are sorted by their words instead.
    """
    three, none = F.lit(3).cast("long"), F.lit(False)

    def total(starts: Column) -> Column:
        return _let(F.sort_array(starts), lambda s: F.aggregate(F.transform(s, lambda x, k: F.least(three, F.coalesce(F.get(s, k + 1) - x, three))), F.lit(0).cast("long"), lambda a, x: a + x))

    def start(x: Column, bits: Column) -> Column:
        return x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)

    def same(x: Column, packed: Column, other: Column, bits: Column) -> Column:
        return F.coalesce(F.call_function("shiftright", x.bitwiseXOR(F.get(packed, other)), bits) == 0, none)

    def covered(packed: Column, bits: Column) -> Column:
        return total(F.transform(F.filter(packed, lambda x, k: same(x, packed, k - 1, bits) | same(x, packed, k + 1, bits)), lambda x: start(x, bits)))

    def clash(words: Column, packed: Column, bits: Column) -> Column:
        def unlike(x: Column, k: Column) -> Column:
            a, b = (start(y, bits).cast("int") for y in (x, F.get(packed, k + 1)))
            return same(x, packed, k + 1, bits) & ((F.get(words, a) != F.get(words, b)) | (F.get(words, a + 1) != F.get(words, b + 1)) | (F.get(words, a + 2) != F.get(words, b + 2)))

        return F.size(F.filter(packed, unlike)) > 0

    def exact(words: Column) -> Column:
        window = lambda i: F.struct(F.struct(F.get(words, i).alias("a"), F.get(words, i + 1).alias("b"), F.get(words, i + 2).alias("c")).alias("w"), i.cast("long").alias("at"))
        windows = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - 3), window))
        like = lambda x, other: F.coalesce(x["w"] == other["w"], none)
        return _let(windows, lambda p: total(F.transform(F.filter(p, lambda x, k: like(x, F.get(p, k - 1)) | like(x, F.get(p, k + 1))), lambda x: x["at"])))

    def packed(words: Column, bits: Column) -> Column:
        window = lambda i: F.call_function("shiftleft", F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)), bits).bitwiseOR(i.cast("long"))
        return F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - 3), window))

    count = lambda w, b: _let(packed(w, b), lambda p: F.when(clash(w, p, b), exact(w)).otherwise(covered(p, b)))
    return _let(words, lambda w: F.when(F.size(w) >= 4, _let(F.ceil(F.log2(F.size(w) + 1.0)).cast("int"), lambda b: count(w, b))).otherwise(F.lit(0).cast("long")))


def metrics(text: Column) -> dict[str, Column]:
    """Every metric as an expression of its own over ``text``."""
    whole = F.coalesce(text, F.lit(""))
    has_word = lambda line: F.btrim(line, F.lit(" " + "".join(SPACES))) != ""
    lines = F.filter(F.split(whole, "\n"), has_word)
    share = lambda test: F.size(F.filter(lines, test)).cast("long")
    return {
        "n_words": word_count(text),
        "word_chars": F.length(F.replace(spaced(text), F.lit(" "), F.lit(""))).cast("long"),
        "n_symbols": _code_points_of(whole, SYMBOLS),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
        "n_repeat_words": _repeat_words(words_of(text)),
        "n_upper": (F.length(whole) - F.length(F.regexp_replace(whole, "\\p{Lu}+", ""))).cast("long"),
        "n_letters": (F.length(whole) - F.length(F.regexp_replace(whole, "[\\p{L}\\p{M}]+", ""))).cast("long"),
        "n_cut_lines": share(lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…")),
        "n_bullets": share(lambda x: F.ltrim(x).startswith("•") | F.ltrim(x).startswith("- ") | F.ltrim(x).startswith("* ")),
    }


M = dict[str, Column]


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps the metrics of a text to a condition under which it goes."""

    name: str
    rejects: Callable[[M], Column]


#: The two rules of the base verdict, then those of the method.
BASE_RULES = (
    Rule("few_words", lambda m: m["n_words"] < 50),
    Rule("repeated_words", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
)
METHOD_RULES = (
    Rule("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("word_length", lambda m: ~m["word_chars"].between(2 * m["n_words"], 20 * m["n_words"])),
    Rule("repeated_lines", lambda m: (m["n_dup_lines"] > 3) & (2 * m["n_dup_lines"] > m["n_lines"])),
    Rule("shouting", lambda m: 10 * m["n_upper"] > 4 * m["n_letters"]),
    Rule("few_letters", lambda m: 10 * m["n_letters"] < 6 * m["word_chars"]),
    Rule("cut_lines", lambda m: (m["n_cut_lines"] > 0) & (10 * m["n_cut_lines"] > 3 * m["n_lines"])),
    Rule("bullets", lambda m: (m["n_bullets"] > 3) & (10 * m["n_bullets"] > 9 * m["n_lines"])),
)
RULES = BASE_RULES + METHOD_RULES


@dataclass(frozen=True)
class Estimate:
    rule: str
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return (self.rejected + 1e-4) / max(self.seconds, 1e-4)


def sample_of(docs: DataFrame, rows: int, text: str = "text") -> DataFrame:
    """About ``rows`` rows, drawn by the hash of the id from all of ``docs``, as a table; fewer where there are no more."""
    total = docs.count()
    share = min(1.0, rows / max(1, total))
    # Null ids are drawn by their text, so a table without ids has a sample too.
    drawn = F.pmod(F.xxhash64(F.lit("sample"), F.coalesce(F.col("doc_id").cast("string"), F.col(text).cast("string"))), F.lit(1 << 20)) < F.lit(max(1, int(share * (1 << 20))))
    return materialise((docs if share == 1.0 else docs.where(drawn)).select(F.col(text).alias(TEXT)), "quality-sample")


def estimate(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 1000, text: str = "text", rounds: int = 2) -> list[Estimate]:
    """Time and rejection share of each rule on a sample of about ``sample_rows`` rows, best first.

    The time of a rule is the least of some runs, after one that compiles it, above that of a
    job which only reads the sample. Only the order of the rules comes from it.
    """
    sample = sample_of(docs, sample_rows, text)
    total = max(1, sample.count())

    def run(condition: Column) -> tuple[float, int]:
        flags = sample.select(F.count_if(condition).alias("n"))
        took = []
        for _ in range(rounds + 1):
            began = time.perf_counter()
            n = flags.first()["n"]
            took.append(time.perf_counter() - began)
        return min(took[1:]), n

    nothing, _ = run(F.length(TEXT) < 0)
    found = []
    for rule in rules:
        seconds, rejected = run(rule.rejects(metrics(F.col(TEXT))))
        found.append(Estimate(rule.name, max(0.0, seconds - nothing), rejected / total))
    return sorted(found, key=lambda e: (-e.worth, e.rule))


def order(rules: tuple[Rule, ...], estimates: list[Estimate]) -> tuple[Rule, ...]:
    place = {e.rule: i for i, e in enumerate(estimates)}
    return tuple(sorted(rules, key=lambda r: place[r.name]))


def passes(rules: tuple[Rule, ...], m: M) -> Column:
    """True if no rule rejects: a CASE, so a rule runs only if all before it let the row by."""
    chain = None
    for rule in rules:
        bad = rule.rejects(m)
        chain = F.when(bad, F.lit(False)) if chain is None else chain.when(bad, F.lit(False))
    return F.lit(True) if chain is None else chain.otherwise(F.lit(True))


class _Reads(dict):
    """Metrics that tell which of them were asked for."""

    def __init__(self, m: M):
        super().__init__(m)
        self.names: set[str] = set()

    def __getitem__(self, name: str) -> Column:
        self.names.add(name)
        return super().__getitem__(name)


def shared_metrics(rules: tuple[Rule, ...], m: M) -> list[str]:
    """Metrics that more than one rule reads."""
    seen: list[str] = []
    for rule in rules:
        reads = _Reads(m)
        rule.rejects(reads)
        seen += reads.names
    return sorted(n for n in set(seen) if seen.count(n) > 1)


def apply_cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 1000) -> DataFrame:
    """Rows of ``docs`` that no rule rejects, with their columns as they came: equal rows all stay or all go, a null or
    empty text goes by ``few_words``, and columns may have any names.

    Metrics that several rules read are taken once for a row; the rest, among them the
    costly one of repeated windows, only where the cascade gets to their rule.
    """
    ranked = order(rules, estimate(docs, rules, sample_rows))
    exprs, own = metrics(F.col("text")), fresh(TEXT, docs.columns)
    shared = shared_metrics(ranked, exprs)
    df = docs.withColumns({f"{own}_{n}": exprs[n] for n in shared})
    have = exprs | {n: F.col(f"{own}_{n}") for n in shared}
    # rand() keeps the filter above the shared metrics: pushed down, it would take them for each rule.
    return df.withColumn(f"{own}_ok", F.when(F.rand(0) < 2, passes(ranked, have))).where(f"{own}_ok").select(*[F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, sample_rows: int = 1000) -> DataFrame:
    """One row per document: the base metrics, the base verdict and the cascade's.

    The base metrics are contract columns, so they are computed for every row;
    the cascade short-circuits the others.
    """
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    ranked = order(METHOD_RULES, estimate(docs, METHOD_RULES, sample_rows))
    exprs = metrics(F.col(TEXT))
    df = docs.select("doc_id", F.col("text").alias(TEXT)).select("doc_id", TEXT, *[exprs[m].alias(m) for m in base])
    have: M = exprs | {m: F.col(m) for m in base}
    failed = F.coalesce(passes(BASE_RULES, have) == F.lit(False), F.lit(False))
    # rand() keeps a filter on a verdict above this row: pushed down, it would measure every text twice.
    verdict = F.when(F.rand(0) < 2, F.when(failed, F.lit(False)).otherwise(passes(ranked, have)))
    return df.select("doc_id", *base, failed.alias("base_failed"), verdict.alias("kept"))
