"""Benchmark decontamination with a BM25 index and block-max WAND.

The test items are the index, every passage of the training texts is a query.
Scores are divided by the item's score against itself, so one threshold serves
all items. All passages of a batch are first tested together: over the short
posting lists of an item's rare terms, a partial score plus the most that its
other terms can add must reach the threshold. Those that pass are searched by
block-max WAND over all lists, which returns every item above the threshold,
and each find is verified: most words of the item's question and of its answer
must stand in the text in runs of three words as they do in the item.

The index is sent to the executors, so items are taken in shards of at most
``SHARD_BYTES`` of text; each shard is one pass over the texts, and a worker
builds its index once. Document frequencies and the mean length are those of all
items, so a score does not depend on the shards.

Defined results: a null or empty text matches nothing; null and empty items
are never matched; items with equal texts are each reported; rows with one
doc_id are judged one by one; other columns are ignored; empty tables give
empty results. Texts are read whole, in passages of 128 words, 64 apart.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, map_batches, materialise, utf8

PASSAGE, STRIDE = 128, 64
THRESHOLD = 0.55
QUESTION, ANSWER, RUN = 0.8, 0.5, 3
K1, B = 1.2, 0.75
BLOCK = 64
SHARD_BYTES = 16 << 20


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).lower().split()


def split_item(text: str) -> tuple[list[bytes], list[bytes]]:
    """Question and answer: the answer is the last sentence, or the last quarter of a single one."""
    words = words_of(text)
    ends = [i + 1 for i, w in enumerate(words[:-1]) if w[-1:] in b".?!"]
    cut = ends[-1] if ends else len(words) - max(1, len(words) // 4)
    return words[:cut], words[cut:]


def parts_of(words: list[bytes]) -> list[list[bytes]]:
    """What is indexed of an item: STRIDE words at a time, so that a passage can hold each part whole."""
    return [words[at : at + STRIDE] for at in range(0, len(words), STRIDE)]


@dataclass(frozen=True)
class Corpus:
    """Parts and words of all items, and in how many parts each term stands (of the terms that are asked for)."""

    parts: int
    words: int
    df: dict[bytes, int]


class Index:
    """Inverted lists with an impact for each posting and its maximum for each block of postings."""

    def __init__(self, items: list[tuple[int, str]], corpus: "Corpus | None" = None):
        """``corpus`` has the statistics of all items where these are not all."""
        self.items = [(i, *split_item(t)) for i, t in items]
        self.owner: list[int] = []
        parts: list[Counter] = []
        for n, (_, q, a) in enumerate(self.items):
            words = q + a
            for part in parts_of(words):
                parts.append(Counter(part))
                self.owner.append(n)
        self.size = len(parts)
        corpus = corpus or Corpus(self.size, sum(sum(p.values()) for p in parts), Counter(t for p in parts for t in p))
        df, mean = corpus.df, corpus.words / max(1, corpus.parts)
        idf = {t: math.log(1 + (corpus.parts - d + 0.5) / (d + 0.5)) for t, d in df.items()}
        self.lists: dict[bytes, tuple[list[int], list[float], list[float], float]] = {}
        raw: dict[bytes, list[tuple[int, float]]] = {}
        shares: list[dict[bytes, float]] = []
        for n, p in enumerate(parts):
            norm = K1 * (1 - B + B * sum(p.values()) / mean)
            impact = {t: idf[t] * k * (K1 + 1) / (k + norm) for t, k in p.items()}
            own = sum(impact.values())
            shares.append({t: v / own for t, v in impact.items()})
            for t, v in shares[-1].items():
                raw.setdefault(t, []).append((n, v))
        for t, posts in raw.items():
            ids, values = [x[0] for x in posts], [x[1] for x in posts]
            blocks = [max(values[i : i + BLOCK]) for i in range(0, len(values), BLOCK)]
            self.lists[t] = (ids, values, blocks, max(values))
        # Rare lists for the joint test: every term in few parts, and further terms of a part until the rest cannot reach the threshold.
        few = max(2, corpus.parts // 50)
        self.rest = np.zeros(self.size)
        rare: dict[bytes, list[tuple[int, float]]] = {}
        for n, s in enumerate(shares):
            left = 1.0
            for t in sorted(s, key=lambda t: (df[t], t)):
                if df[t] > few and left < 0.6 * THRESHOLD:
                    break
                rare.setdefault(t, []).append((n, s[t]))
                left -= s[t]
            self.rest[n] = max(0.0, left)
        self.term = {t: k for k, t in enumerate(rare)}
        self.first = np.cumsum([0] + [len(v) for v in rare.values()])
        self.posted = np.array([n for v in rare.values() for n, _ in v], np.int64)
        self.impact = np.array([x for v in rare.values() for _, x in v])
        self.grams = [({tuple(x[i : i + RUN]) for i in range(len(x) - RUN + 1)}) for x in (q + a for _, q, a in self.items)]

    def wand(self, terms: set[bytes], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """Every part whose score for the query reaches the threshold, with the score."""
        cursors = [[self.lists[t][0][0], 0, *self.lists[t]] for t in sorted(terms) if t in self.lists]
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, None
            for k, c in enumerate(cursors):
                bound += c[5]
                if bound >= threshold:
                    pivot = k
                    break
            if pivot is None:
                break
            target = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == target:
                pivot += 1
            # The blocks that would hold the pivot, without decoding them.
            blocks = []
            for c in cursors[: pivot + 1]:
                at = bisect_left(c[2], target, c[1]) // BLOCK
                blocks.append((c, at))
            if sum(c[4][at] for c, at in blocks if at < len(c[4])) < threshold:
                # No item up to the nearest block end can reach it.
                ends = [c[2][min((at + 1) * BLOCK, len(c[2])) - 1] + 1 for c, at in blocks if at < len(c[4])]
                beyond = cursors[pivot + 1][0] if pivot + 1 < len(cursors) else self.size
                self._advance(cursors, pivot, max(target + 1, min([*ends, beyond])))
            elif cursors[0][0] == target:
                score = sum(c[3][c[1]] for c in cursors[: pivot + 1])
                if score >= threshold:
                    found.append((target, score))
                self._advance(cursors, pivot, target + 1)
            else:
                self._advance(cursors, pivot, target)
            cursors = [c for c in cursors if c[0] < self.size]
        return found

    def _advance(self, cursors: list, pivot: int, to: int) -> None:
        for c in cursors[: pivot + 1]:
            if c[0] < to:
                c[1] = bisect_left(c[2], to, c[1])
                c[0] = c[2][c[1]] if c[1] < len(c[2]) else self.size

    def passages(self, texts: list[list[bytes]]) -> list[tuple[int, int]]:
        """Text and first word of the passages that pass the joint test."""
        starts = [np.arange(0, max(1, len(w) - (PASSAGE - STRIDE)), STRIDE) for w in texts]
        begin = np.cumsum([0] + [len(s) for s in starts])
        terms, slots = [], []
        get = self.term.get
        for n, w in enumerate(texts):
            ids = np.fromiter((get(x, -1) for x in w), np.int64, len(w))
            at = np.flatnonzero(ids >= 0)
            for back in (0, 1):  # a word lies in the passage that begins in its stride, and in the one before
                k = at // STRIDE - back
                ok = (k >= 0) & (k < len(starts[n]))
                terms.append(ids[at[ok]])
                slots.append(begin[n] + k[ok])
        if not terms or not self.size:
            return []
        pair = np.unique(np.concatenate(slots) * len(self.term) + np.concatenate(terms)) if self.term else np.empty(0, np.int64)
        if not len(pair):
            return []
        slot, term = pair // len(self.term), pair % len(self.term)
        count = self.first[term + 1] - self.first[term]
        post = np.repeat(self.first[term] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        key, where = np.unique(np.repeat(slot, count) * self.size + self.posted[post], return_inverse=True)
        partial = np.bincount(where, weights=self.impact[post])
        passed = np.unique(key[partial + self.rest[key % self.size] >= THRESHOLD - 1e-9] // self.size)
        text = np.searchsorted(begin, passed, side="right") - 1
        return [(int(t), int(starts[t][s - begin[t]])) for t, s in zip(text, passed, strict=True)]

    def overlap(self, n: int, words: list[bytes]) -> tuple[float, float]:
        """Share of the question's and the answer's words in runs of RUN words that ``words`` has too."""
        _, q, a = self.items[n]
        item = q + a
        width = min(RUN, len(item))
        have = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
        covered = np.zeros(len(item), bool)
        for i in range(len(item) - width + 1):
            if tuple(item[i : i + width]) in have:
                covered[i : i + width] = True
        return float(covered[: len(q)].mean()) if q else 1.0, float(covered[len(q) :].mean()) if a else 1.0

    def search(self, texts: list[list[bytes]]) -> dict[tuple[int, int], tuple[float, float, float, int]]:
        """(text, item) -> score, question and answer overlap, first word of the passage; the best passage of each."""
        out: dict[tuple[int, int], tuple[float, float, float, int]] = {}
        for t, at in self.passages(texts):
            words = texts[t]
            for part, score in self.wand(set(words[at : at + PASSAGE])):
                n = self.owner[part]
                if (t, n) in out and out[t, n][0] >= score:
                    continue
                reach = len(self.items[n][1]) + len(self.items[n][2])
                q, a = self.overlap(n, words[max(0, at - reach) : at + PASSAGE + reach])
                if q >= QUESTION and a >= ANSWER:
                    out[t, n] = (score, q, a, at)
        return out


TERMS = "shard long, term binary, parts long, words long"


def _terms(own: DataFrame) -> DataFrame:
    """For each item and term the number of its parts that have it, and for a null term its parts and their words."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for shard, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                question, answer = split_item(text)
                parts = parts_of(question + answer)
                rows.append((shard, None, len(parts), sum(map(len, parts))))
                rows += [(shard, term, n, 0) for term, n in Counter(t for p in parts for t in set(p)).items()]
            cols = list(zip(*rows, strict=True)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.int64(), pa.int64()), strict=True)], names=[c.split()[0] for c in TERMS.split(", ")])

        return step

    return materialise(map_batches(own.select("shard", "text"), make, TERMS), "bench-terms")


def shards(items: DataFrame, shard_bytes: int = SHARD_BYTES) -> Iterator[tuple[list[tuple[int, str]], Corpus]]:
    """The items in lists of about ``shard_bytes`` of text at most, each read when it is needed, with the statistics of all."""
    own = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and trim(text) <> ''")
    size = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = -(-size // shard_bytes)
    if not n:
        return
    own = own.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    terms = _terms(own)
    whole = terms.where("term is null").agg(F.sum("parts").alias("parts"), F.sum("words").alias("words")).first()
    df = terms.where("term is not null").groupBy("term").agg(F.sum("parts").alias("df"))
    for k in range(n):
        rows = [(r["item_id"], r["text"]) for r in own.where(F.col("shard") == k).orderBy("item_id", "text").collect()]
        # The terms of a shard are bounded by its text.
        mine = df.join(terms.where(F.col("shard") == k).select("term").distinct(), "term", "left_semi").collect()
        yield rows, Corpus(whole["parts"] or 0, whole["words"] or 0, {bytes(r["term"]): r["df"] for r in mine})


def _index(shard: list[tuple[int, str]], corpus: Corpus) -> Index:
    """The index of a shard, built once by a worker."""
    import hashlib

    key = hashlib.sha256(repr((shard, corpus.parts, corpus.words)).encode("utf-8", "surrogatepass")).hexdigest()
    return held(f"decontam-{key}", lambda: Index(shard, corpus))


HITS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long"


def find(docs: DataFrame, items: DataFrame) -> DataFrame:
    """A row (columns of ``HITS``) for each document and item that it contains."""
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
    names = [c.split()[0] for c in HITS.split(", ")]
    out = docs.sparkSession.createDataFrame([], HITS)
    for shard, corpus in shards(items):

        def make(shard=shard, corpus=corpus):
            index = _index(shard, corpus)

            def step(batch: pa.RecordBatch) -> pa.RecordBatch:
                ids = batch.column(0).to_pylist()
                hits = index.search([words_of(c.as_py()) for c in batch.column(1)])
                rows = [(ids[t], index.items[n][0], *x) for (t, n), x in sorted(hits.items())]
                cols = list(zip(*rows, strict=True)) or [()] * 6
                return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, types, strict=True)], names=names)

            return step

        out = out.union(map_batches(own, make, HITS))
    return out


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows that contain an item; columns as they came, no shuffle."""
    at = docs.columns.index("text")
    for shard, corpus in shards(items):

        def make(shard=shard, corpus=corpus):
            index = _index(shard, corpus)

            def step(batch: pa.RecordBatch) -> pa.RecordBatch:
                hit = {t for t, _ in index.search([words_of(c.as_py()) for c in batch.column(at)])}
                return batch.filter(pa.array([i not in hit for i in range(batch.num_rows)], pa.bool_()))

            return step

        docs = map_batches(docs, make, docs.schema)
    return docs
