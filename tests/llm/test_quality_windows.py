"""Repeated windows of op10_quality where hashes of unlike windows are equal."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from seatledger.llm import quality


def brute(words):
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    return len({k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in range(i, i + 3)}) if len(words) > 3 else 0


@pytest.mark.parametrize("weak", [None, lambda *w: F.lit(5).cast("long"), lambda *w: F.ascii(w[0]).cast("long")])
def test_equal_hashes_of_unlike_windows(spark, monkeypatch, weak):
    rng = random.Random(8)
    texts = [[rng.choice("abcdefg"[:v]) for _ in range(n)] for v in (1, 3, 7) for n in (0, 2, 3, 4, 9, 40, 150)] + [[f"{k}" for k in range(200)]]
    if weak:
        monkeypatch.setattr(quality.F, "xxhash64", weak)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = dict(docs.select("doc_id", quality.metrics(F.col("text"))["n_repeat_words"]).collect())
    assert got == {i: brute(t) for i, t in enumerate(texts)}
