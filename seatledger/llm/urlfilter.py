"""URLs judged by written rules, and by two character models where no rule fits.

URLs that a rule allows or blocks are the accepted and the rejected ones that a variable-order
Markov model each learns from. A model's contexts are the strings of up to six symbols (bytes,
start and end) whose continuations are common enough: an n-gram stays if it makes up at least
``SHARE`` of all the training symbols of its model, so a length has at most 1 / SHARE of them
whatever the size of the corpus, and a context may be long in one place and short in another.
Probabilities of a context are interpolated with those of the context shorter by a symbol,
by the number of its distinct continuations (Witten and Bell), down to one more than nothing
for each symbol. The score of a URL is the difference of its two log-probabilities for each
symbol. One labelled URL in eight teaches no model: on these the cut is calibrated, where the
share of accepted ones below and of rejected ones above it is least.

Counts are made in tasks for each batch and added up by Spark over all rows; what reaches
the driver, and goes out again with the scoring pass, is bounded by SHARE.

Defined results: without ``://`` and for null, host and path are empty and no rule fits; such
a URL is scored all the same, null as the empty string. With no accepted or no rejected URLs
nothing tells them apart: the score is 0 and the verdict allow. Ties go to allow. Repeated
rows count again; other columns are ignored; URLs are read whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean_batches, map_batches, materialise, utf8

#: Rule (host and start of the path), verdict.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
ORDER = 6
SHARE = 1 / 50_000
#: Nine bits a symbol: 0 before the start, a byte plus one, END after the last.
BITS, END = 9, 257
SYMBOLS = 257
#: One labelled URL of so many is kept for the cut; scores are counted in bins of 1 / BINS, up to REACH on both sides.
CALIBRATE, BINS, REACH = 8, 64, 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lowered, and path."""
    at = F.instr(url, "://")
    rest = F.when(F.coalesce(at, F.lit(0)) > 0, F.substring(url, at + 3, F.lit(2**31 - 1))).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule whose host is this one or a parent of it and whose path begins this one: struct of rule and verdict, or null."""
    out = None
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + start))
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if out is None else out


def grams(urls: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram of ORDER + 1 symbols that ends at each symbol of each URL, A-Z lowered, and where each URL starts."""
    texts = [utf8(u).lower() for u in urls]  # of bytes, so A-Z only
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    start = np.cumsum(size) - size
    symbols = np.full(int(size.sum()), END, np.int64)
    inside = np.ones(len(symbols), bool)
    inside[start + size - 1] = False
    symbols[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + 1
    place = np.arange(len(symbols)) - np.repeat(start, size)
    out = symbols.copy()
    for k in range(1, ORDER + 1):
        out[k:] |= np.where(place[k:] >= k, symbols[: len(symbols) - k], 0) << BITS * k
    return out, start


@dataclass
class Markov:
    """Kept n-grams by length with their counts, and their contexts with the sum and the number of their continuations."""

    total: int
    grams: list[np.ndarray]
    counts: list[np.ndarray]
    contexts: list[np.ndarray]
    sums: list[np.ndarray]
    kinds: list[np.ndarray]

    @classmethod
    def of(cls, length: np.ndarray, gram: np.ndarray, n: np.ndarray, total: int) -> "Markov":
        out = cls(total, [], [], [], [], [])
        for k in range(1, ORDER + 2):
            mine = length == k
            order = np.argsort(gram[mine], kind="stable")
            g, c = gram[mine][order], n[mine][order].astype(np.float64)
            contexts, first = np.unique(g >> BITS, return_index=True)
            out.grams.append(g)
            out.counts.append(c)
            out.contexts.append(contexts)
            out.sums.append(np.add.reduceat(c, first) if len(g) else c)
            out.kinds.append(np.diff(np.r_[first, len(g)]).astype(np.float64))
        return out

    def log(self, full: np.ndarray) -> np.ndarray:
        """Log-probability of the last symbol of each full n-gram after the others."""
        p = (_find(self.grams[0], full & (1 << BITS) - 1, self.counts[0]) + 1) / (self.total + SYMBOLS)
        for k in range(2, ORDER + 2):
            if not len(self.grams[k - 1]):
                break
            g = full & (1 << BITS * k) - 1
            context = g >> BITS
            kinds, total = _find(self.contexts[k - 1], context, self.kinds[k - 1]), _find(self.contexts[k - 1], context, self.sums[k - 1])
            known = np.flatnonzero(kinds)
            c = _find(self.grams[k - 1], g[known], self.counts[k - 1])
            p[known] = (c + kinds[known] * p[known]) / (total[known] + kinds[known])
        return np.log(p)


def _find(keys: np.ndarray, asked: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(asked))
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0.0)


@dataclass
class Model:
    accepted: Markov
    rejected: Markov
    cut: float = 0.0

    def scores(self, urls: list[str | None]) -> np.ndarray:
        """Difference of the log-probabilities for each symbol, the end counted."""
        if not urls:
            return np.zeros(0)
        full, start = grams(urls)
        each = self.accepted.log(full) - self.rejected.log(full)
        return np.add.reduceat(each, start) / np.diff(np.r_[start, len(full)])


def _labelled(pages: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """url, accepted, held of the pages that a rule decides."""
    host, path = parts(F.col("url"))
    rule = pages.select("url", fitting(host, path, rules).alias("r")).where("r is not null")
    return rule.select("url", (F.col("r.verdict") == "allow").alias("accepted"), (F.crc32(F.col("url").cast("binary")) % CALIBRATE == 0).alias("held"))


def _counted(training: DataFrame) -> DataFrame:
    """accepted, gram, n over all training URLs: full n-grams, added up in each batch first."""
    lean_batches(training.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for accepted in (True, False):
                urls = batch["url"].filter(batch["accepted"] if accepted else pc.invert(batch["accepted"])).to_pylist()
                if urls:
                    g, n = np.unique(grams(urls)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), accepted)), pa.array(g), pa.array(n)], names=["accepted", "gram", "n"])

    return training.select("url", "accepted").mapInArrow(run, "accepted boolean, gram long, n long").groupBy("accepted", "gram").agg(F.sum("n").alias("n"))


def learn(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, share: float = SHARE) -> Model | None:
    """Both models and the cut; None if there are no accepted or no rejected URLs to learn from."""
    labelled = _labelled(pages, rules)
    full = materialise(_counted(labelled.where("not held")), "url-grams")
    totals = {r["accepted"]: int(r["n"]) for r in full.groupBy("accepted").agg(F.sum("n").alias("n")).collect()}
    if len(totals) < 2:
        return None
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("length"), F.col("gram").bitwiseAND((1 << BITS * k) - 1).alias("gram")) for k in range(1, ORDER + 2)]))
    kept = full.select("accepted", "n", each.alias("g")).groupBy("accepted", "g.length", "g.gram").agg(F.sum("n").alias("n"))
    kept = kept.where(F.col("n") >= F.when(F.col("accepted"), share * totals[True]).otherwise(share * totals[False])).toArrow()
    side = lambda x: kept.filter(kept["accepted"] if x else pc.invert(kept["accepted"]))
    model = Model(*[Markov.of(*[side(x)[c].to_numpy() for c in ("length", "gram", "n")], totals[x]) for x in (True, False)])
    model.cut = _cut(labelled.where("held"), model)
    return model


def _cut(held: DataFrame, model: Model) -> float:
    """Where accepted URLs below and rejected ones from there on are the least shares of theirs; nearest to 0 among equals."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            bins = np.clip(np.floor(model.scores(batch["url"].to_pylist()) * BINS), -REACH * BINS, REACH * BINS).astype(np.int32)
            return pa.RecordBatch.from_arrays([batch["accepted"], pa.array(bins)], names=["accepted", "bin"])

        return step

    n = np.zeros((2, 2 * REACH * BINS + 1))
    for r in map_batches(held.select("url", "accepted"), make, "accepted boolean, bin int").groupBy("accepted", "bin").count().collect():
        n[int(r["accepted"]), r["bin"] + REACH * BINS] = r["count"]
    if not n.sum(1).all():
        return 0.0
    low = np.c_[np.zeros(2), n.cumsum(1)] / n.sum(1)[:, None]
    wrong = low[1] + 1 - low[0]
    at = np.arange(len(wrong)) - REACH * BINS
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return float(at[best[np.abs(at[best]).argmin()]]) / BINS


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, share: float = SHARE) -> DataFrame:
    """page_id, host, path, rule, verdict, score: the verdict is the rule's, or else that of the score against the cut."""
    model = learn(pages, rules, share)
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", "url", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    rows = rows.withColumn("r", fitting(F.col("host"), F.col("path"), rules)).select("page_id", "url", "host", "path", "r.rule", "r.verdict")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            score = np.zeros(batch.num_rows) if model is None else model.scores(batch["url"].to_pylist())
            own = np.where(score >= (0.0 if model is None else model.cut), "allow", "block").tolist()
            verdict = [v or o for v, o in zip(batch["verdict"].to_pylist(), own, strict=True)]
            return pa.RecordBatch.from_arrays([batch["page_id"], batch["host"], batch["path"], batch["rule"], pa.array(verdict, pa.string()), pa.array(score)], names=["page_id", "host", "path", "rule", "verdict", "score"])

        return step

    kind = dict(pages.dtypes)["page_id"]
    return map_batches(rows, make, f"page_id {kind}, host string, path string, rule string, verdict string, score double")
