"""Spelling variants against a comparison of all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from seatledger.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, cell int, h string"
LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)


def brute(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 7:
                n[run] += 1
    n = {w: k for w, k in n.items() if k >= 2}
    near = {w: [x for x in n if spelling.one_apart(w.encode("latin-1"), x.encode("latin-1"))] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return sorted(out)


def corpus():
    rng = random.Random(3)
    bases = ["".join(rng.choice("eeennaitohrsé") for _ in range(rng.randint(6, 11))) for _ in range(40)]
    words = list(bases)
    for b in bases:
        for _ in range(12):
            k, c = rng.randrange(len(b)), rng.choice("aeintñÿ")
            words.append(rng.choice([b[:k] + b[k + 1 :], b[:k] + c + b[k:], b[:k] + c + b[k + 1 :]]))
    # Chains of forms, ties of the largest count, and words in a group of letters each.
    times = {"statement": 1500, "statemend": 120, "statemant": 10, "stotemant": 2, "aaaaaaaa": 2, "aaaaaaaaa": 2, "aaaaaaaaaaaaaaaa": 3, "aaaaaaaaaaaaaaaaa": 30, "bbbbbbb": 2, "bbbbbbp": 40, "bbbbbbn": 40, "Ünderdog": 4, "ünderdog": 4}
    long = "xyz" * 40
    times |= {long: 40, long + "a": 4, long[:60] + "q" + long[60:]: 3, long[:100] + "e" + long[101:]: 2}
    bag = [w for w, k in times.items() for _ in range(k)] + [w for w in words for _ in range(rng.choice([1, 2, 2, 5, 60]))]
    rng.shuffle(bag)
    rows = [(i, rng.choice([" ", ", ", "1", "_", "\n"]).join(bag[i * 90 : i * 90 + 90])) for i in range(len(bag) // 90 + 1)]
    rows += [(None, "STATEMENT statement ×÷×÷×÷×"), (None, "STATEMENT statement ×÷×÷×÷×"), (-4, None), (5, ""), (5, "日本語 seven77seven Ünderdog"), (7, "statement " * 3000)]
    return rows


@pytest.fixture(scope="module")
def want():
    return brute(corpus())


def rows_of(df):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


@pytest.mark.parametrize("cell_words", [2, 50, spelling.CELL_WORDS])
def test_groups(spark, want, cell_words):
    docs = spark.createDataFrame([(i, t, "w", 1, 2, "h") for i, t in corpus()], SCHEMA).repartition(3)
    got = spelling.group(docs, cell_words=cell_words)
    assert rows_of(got) == want
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert any(form and root != form for _, form, root, *_ in want) and any(near and form is None for _, form, _, _, near, _ in want)


def test_small_batches(spark, want, monkeypatch):
    """Words that ask in several batches, pairs in several slices, vectors branched down to one."""
    monkeypatch.setattr(spelling, "BATCH", 16)
    monkeypatch.setattr(spelling, "PAIRS", 8)
    monkeypatch.setattr(spelling, "BUCKET", 1)
    docs = spark.createDataFrame([(i, t, "w", 1, 2, "h") for i, t in corpus()], SCHEMA)
    assert rows_of(spelling.group(docs, cell_words=9)) == want


def test_visited_cells(spark, want, monkeypatch):
    """A cell that many words visit is dealt to several tasks; each has all words of the cell, a visitor goes to one."""
    routed = spark.createDataFrame([(c, k < 5, f"word{c}{k:04d}", k) for c, m in ((0, 1005), (1, 90)) for k in range(m)], "cell int, mine boolean, word string, n long")
    rows = spelling.shared_out(routed, 100).collect()
    assert {r["part"] for r in rows if r["cell"] == 0} == set(range(10)) and {r["part"] for r in rows if r["cell"] == 1} == {0}
    assert set(Counter(r["word"] for r in rows if r["mine"] and r["cell"] == 0).values()) == {10}
    visitors = [r for r in rows if not r["mine"]]
    assert len(visitors) == len({r["word"] for r in visitors}) == 1085
    assert max(Counter((r["cell"], r["part"]) for r in visitors).values()) < 200
    monkeypatch.setattr(spelling, "ASKED", 1)
    docs = spark.createDataFrame([(i, t, "w", 1, 2, "h") for i, t in corpus()], SCHEMA)
    assert rows_of(spelling.group(docs, cell_words=20)) == want


def test_no_rows(spark):
    assert spelling.group(spark.createDataFrame([], SCHEMA)).count() == 0
    assert spelling.group(spark.createDataFrame([(1, "only once alone", "w", 1, 2, "h")], SCHEMA)).count() == 0


def test_search_meets_each_pair_once():
    """In the trie, near words meet exactly once, from the larger vector."""
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("enait") for _ in range(rng.randint(7, 9))) for _ in range(600)})
    found = Counter()
    cell = spelling.Cell(spelling.Words([w.encode() for w in words], np.ones(len(words), np.int64)))
    gain = spelling.Words.gain

    def watched(self, mine, other, theirs):
        found.update((self.words[i], other.words[j]) for i, j in zip(mine, theirs, strict=True))
        gain(self, mine, other, theirs)

    spelling.Words.gain = watched
    try:
        cell.search(cell.own, True)
    finally:
        spelling.Words.gain = gain
    pairs = {(a.encode(), b.encode()) for a in words for b in words if spelling.one_apart(a.encode(), b.encode())}
    assert set(found) == pairs and set(found.values()) == {1}
