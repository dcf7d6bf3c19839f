"""The matcher of toxic words against a naive one, exceptions and long texts included, and the curve's fit."""

from __future__ import annotations

import random
import time

import numpy as np

from seatledger.llm import toxicity as T

WEIGHTS = T.WORDS | {"blorg" + T.STEM: 1.5, "blorgian": 2.0, "clown fish tank": 0.5}


def naive(text, weights):
    """Every entry at every place, every exception against every hit."""
    t = T.fold(text)
    at = lambda key, stem: [i for i in range(len(t) - len(key) + 1) if t.startswith(key, i) and (i == 0 or not t[i - 1].isalnum()) and (stem or i + len(key) == len(t) or not t[i + len(key)].isalnum())]
    covers = [(i, i + len(T.fold(p))) for p in T.EXCEPTIONS for i in at(T.fold(p), False)]
    best = {}
    for word, w in weights.items():
        key = word.removesuffix(T.STEM)
        for i in at(key, word != key):
            best.setdefault(i, []).append((w, i + len(key)))
    hits = {}
    for i, found in best.items():
        w = max(w for w, _ in found)
        ends = {hi for x, hi in found if x == w}
        hits[i] = (w, ends)
    kept = {i: w for i, (w, ends) in hits.items() if not any(a <= i and all(hi <= b for hi in ends) for a, b in covers)}
    return float(sum(kept.values())), len(kept), len(t.split())


def test_features_against_naive():
    rng = random.Random(6)
    bits = [*T.WORDS, *T.EXCEPTIONS, "clown", "fish", "clown fish tank", "blorg", "blorgia", "blorgian", "xclown", "the", "1d10t", "ѕtupid", "IDIOT", "soap", "scum", "pond", "trash", "can"]
    auto = T._automaton(WEIGHTS)
    for _ in range(400):
        text = rng.choice(["", " ", "."]).join(rng.choice(bits) + rng.choice([" ", ", ", "-", ""]) for _ in range(rng.randint(0, 12)))
        assert T._features(text, WEIGHTS, auto) == naive(text, WEIGHTS), text


def test_exceptions_hold_only_what_they_cover():
    auto = T._automaton(T.WORDS)
    assert T._features("a clown fish", T.WORDS, auto)[1] == 0 and T._features("clown. fish", T.WORDS, auto)[1] == 1
    assert T._features("pond scum and scum", T.WORDS, auto)[:2] == (3.5, 1)


def test_long_texts_are_linear():
    auto = T._automaton(T.WORDS)
    began = time.perf_counter()
    assert T._features("clown fish " * 100_000, T.WORDS, auto) == (0.0, 0, 200_000)
    assert T._features("idiot clown fish " * 50_000, T.WORDS, auto)[1] == 50_000
    assert time.perf_counter() - began < 4


def test_fit_finds_a_planted_curve():
    rng = np.random.default_rng(3)
    x = np.abs(rng.normal(size=(20_000, 2)))
    p = 1 / (1 + np.exp(-(1.5 * x[:, 0] + 0.7 * x[:, 1] - 2)))
    got = T._fit(x, (rng.random(len(x)) < p).astype(float))
    assert np.abs(np.array(got) - [1.5, 0.7, -2]).max() < 0.15
