"""Toxicity by a weighted lexicon.

Texts are folded (case, look-alike letters, digits that stand for letters),
matched against the lexicon by one Aho-Corasick pass, and scored by the weight
of the matches for each hundred words. Exception phrases that cover a match
take it out. The lexicon is a short written list, extended by words that the
labelled training rows show to be toxic; a logistic curve over two features,
fitted on the same rows, turns the weight into a score.

Defined results: a null or empty text has no words and the score of no match;
repeated rows are scored one by one; other columns are ignored. With no usable
training rows (no labels, one class) the written list and a fixed curve decide.
Texts are read whole.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialise

# The written lexicon, word and weight.
WORDS = {
    "idiot": 3.0, "idiots": 3.0, "moron": 3.0, "morons": 3.0, "stupid": 2.5, "dumb": 2.0, "loser": 2.5, "losers": 2.5, "scum": 3.5,
    "trash": 2.5, "garbage": 1.5, "worthless": 3.0, "pathetic": 3.0, "disgusting": 2.5, "clown": 2.5, "clowns": 2.5, "imbecile": 3.0,
    "bastard": 3.5, "bitch": 4.0, "shit": 3.0, "fuck": 3.5, "fucking": 3.5, "asshole": 4.0, "retard": 4.0, "vermin": 3.0, "freak": 2.0,
    "kill yourself": 5.0, "shut up": 2.0, "i hate you": 3.0, "drop dead": 3.5,
}

# Phrases in which a lexicon word is not an insult.
EXCEPTIONS = (
    "clown fish", "clown shoes", "clown school", "circus clown", "trash can", "trash bin", "trash bag", "trash collection", "taking out the trash",
    "garbage collection", "garbage collector", "garbage truck", "garbage can", "dumb terminal", "dumb bell", "sore loser award", "freak accident",
    "freak wave", "freak storm", "pond scum", "stupid question award", "the idiot by dostoevsky", "soap scum", "fire retardant",
)

# Letters that look alike, and digits and signs that stand for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "ѕ": "s", "т": "t", "у": "y", "х": "x", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ⅰ": "i", "ʟ": "l", "​": "", "‌": "", "‍": "", "­": "", "﻿": "",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


def _table() -> dict[int, str]:
    table = {ord(k): v for k, v in LOOKALIKES.items()}
    table |= {ord(k.upper()): v for k, v in LOOKALIKES.items() if len(k.upper()) == 1 and k.upper() != k}
    # Full-width and mathematical letters follow a rule each.
    table |= {0xFF21 + i: chr(97 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)}
    for block in range(0x1D400, 0x1D6A4, 52):
        table |= {block + i: chr(97 + i % 26) for i in range(52)}
    return table


_FOLD = str.maketrans(_table())
_DIGITS = str.maketrans(DIGITS)


def fold(text: str) -> str:
    """Lower case with look-alikes and stand-in digits as letters; the length may shrink."""
    low = text.lower()
    if not low.isascii():
        low = low.translate(_FOLD)
    return low.translate(_DIGITS)


def held_out(doc_id: Column, mod: int, rest: int) -> Column:
    """Rows that no model learns from; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod == rest


@dataclass(frozen=True)
class Lexicon:
    weights: dict[str, float]
    curve: tuple[float, float, float]  # of log(1 + weight per 100 words), of log(1 + weight), constant


def _features(text: str, weights: dict[str, float], auto) -> tuple[float, int, int]:
    """Weight of the matches that stand as words and no exception covers, matches, words."""
    t = fold(text)
    n_words = len(t.split())
    hits: dict[int, tuple[int, float]] = {}
    covers = []
    n = len(t)
    for end, (key, w) in auto.iter(t):
        stem = key[-1] == STEM
        lo, hi = end + 1 - len(key) + stem, end + 1
        if (lo == 0 or not t[lo - 1].isalnum()) and (stem or hi == n or not t[hi].isalnum()):
            if w is None:
                covers.append((lo, hi))
            elif lo not in hits or hits[lo][1] < w:
                hits[lo] = (hi, w)
    if covers:
        # Of the phrases that begin by then, the one that reaches farthest decides.
        covers.sort()
        starts, reach = [a for a, _ in covers], list(accumulate((b for _, b in covers), max))
        hits = {lo: x for lo, x in hits.items() if (k := bisect_right(starts, lo)) == 0 or reach[k - 1] < x[0]}
    return float(sum(x[1] for x in hits.values())), len(hits), n_words


def _automaton(weights: dict[str, float]):
    import ahocorasick

    auto = ahocorasick.Automaton()
    for word, w in weights.items():
        key = word.removesuffix(STEM)
        if not auto.exists(key) or word == key:
            auto.add_word(key, (word, w))
    for phrase in EXCEPTIONS:
        auto.add_word(fold(phrase), (fold(phrase), None))
    auto.make_automaton()
    return auto


# A stem is so long, and counts with so many forms in toxic texts.
STEM_LENGTHS, LEAST_FORMS = (4, 5, 6), 4
# Ends an entry that matches every word it begins.
STEM = "*"
FIXED_CURVE = (2.0, 0.5, -3.0)


def _fit(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps; both features may only raise the score."""
    X = np.column_stack([x, np.ones(len(x))])
    w = np.array([1.0, 0.1, -3.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(X @ w, -30, 30)))
        g = X.T @ (p - y) + ridge * w
        h = (X * (p * (1 - p))[:, None]).T @ X + ridge * np.eye(3)
        step = np.linalg.solve(h, g)
        w = w - np.clip(step, -2, 2)
        w[:2] = np.maximum(w[:2], 0.0)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1]), float(w[2])


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, least_docs: int = 5, least_z: float = 4.5) -> Lexicon:
    """The lexicon and curve from at most ``sample_rows`` labelled rows outside the held-out quarter.

    The rows with the smallest hashes are taken, so the choice depends on the ids only.
    Words are counted over distinct texts, so that copies of one text do not vouch for its words. Every word that
    passes is learnt; there are no more of them than the sample has.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), 4, 2))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample_rows)
    )
    # At most sample_rows rows of two numbers: small enough to send to every executor.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    texts = texts.groupBy(F.xxhash64("text").alias("key")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")
    texts = materialise(texts, "toxic-texts")

    def count_words():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts: dict[str, list[int]] = {}
            forms: dict[str, set[str]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = {w.strip(".,;:!?\"'()[]") for w in fold(text).split()}
                stems = {(w[:k] + STEM, w) for w in words for k in STEM_LENGTHS if len(w) > k}
                for word in words | {x for x, _ in stems}:
                    counts.setdefault(word, [0, 0])[toxic] += 1
                if toxic:
                    for stem, word in stems:
                        if len(own := forms.setdefault(stem, set())) < LEAST_FORMS:
                            own.add(word)
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c[1] for c in counts.values()], pa.int64()), pa.array([c[0] for c in counts.values()], pa.int64()), pa.array([sorted(forms.get(w, ())) for w in counts], pa.list_(pa.string()))], names=["word", "bad", "good", "forms"])

        return step

    n = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = n.get(1, 0), n.get(0, 0)
    if not bad or not good:
        return Lexicon(dict(WORDS), FIXED_CURVE)
    counted = map_batches(texts, count_words, "word string, bad long, good long, forms array<string>", 10_000)
    counted = counted.groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.array_distinct(F.flatten(F.collect_list("forms"))).alias("forms"))
    odds = F.log((F.col("bad") + 0.5) / (bad - F.col("bad") + 0.5)) - F.log((F.col("good") + 0.5) / (good - F.col("good") + 0.5))
    # Signed root of the likelihood ratio: it also holds where the clean texts never have the word.
    share, seen = bad / (bad + good), F.col("bad") + F.col("good")
    part = lambda n, p: F.when(n > 0, n * F.log(n / (seen * p))).otherwise(0.0)
    z = F.sqrt(2 * (part(F.col("bad"), share) + part(F.col("good"), 1 - share)))
    # A word vouches for itself if it stands in enough texts and hardly ever in clean ones.
    # A stem needs several forms, and then less evidence: one copied text does not bring forth a family.
    stem = F.col("word").endswith(STEM)
    known = (F.col("bad") >= max(least_docs, bad // 200)) & (F.col("bad") >= 20 * F.col("good"))
    sure = F.when(stem, (F.size("forms") >= LEAST_FORMS) & (F.col("z") >= least_z - 0.5)).otherwise((F.length("word") > 2) & (F.col("z") >= least_z))
    rows = counted.where(known).select("word", "forms", odds.alias("odds"), z.alias("z")).where(sure).orderBy(F.desc("z"), "word").collect()
    weights = dict(WORDS) | {r["word"]: min(6.0, max(1.0, float(r["odds"]))) for r in rows}
    sums = _totals(texts.withColumn("doc_id", F.col("toxic").cast("long")), weights).select("doc_id", "total", "n_words").collect()
    x = np.array([(math.log1p(100.0 * r["total"] / max(r["n_words"], 1)), math.log1p(r["total"])) for r in sums])
    return Lexicon(weights, _fit(x, np.array([float(r["doc_id"]) for r in sums])))


def _totals(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    def make():
        auto = _automaton(weights)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [_features(t or "", weights, auto) for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())], names=["doc_id", "total", "n_matches", "n_words"])

        return step

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, "doc_id long, total double, n_matches long, n_words long")


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted, n_matches, n_words for every row."""
    a, b, c = lexicon.curve
    z = a * F.log1p(100.0 * F.col("total") / F.greatest("n_words", F.lit(1))) + b * F.log1p("total") + F.lit(c)
    # No match is no evidence: whatever the curve's constant, it stays below the threshold.
    s = F.when(F.col("n_matches") == 0, F.least(F.lit(threshold / 2), 1 / (1 + F.exp(-F.lit(c))))).otherwise(1 / (1 + F.exp(-z)))
    return _totals(docs, lexicon.weights).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), s.alias("score"), (s >= threshold).cast("int").alias("predicted"), "n_matches", "n_words"
    )
