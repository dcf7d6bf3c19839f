"""URL verdicts against a plain reading of the rules and of the models."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import pytest

from seatledger.llm import urlfilter as U

SCHEMA = "page_id long, url string, html string, host string, rule string, r string, score string"
ORG = [None, "", "no scheme", "://", "http://", "HTTP://EXAMPLE.ORG/en/12?x=/es/", "http://a.example.org/en/2", "http://example.org", "http://example.org/es", "http://example.org/es/1", "http://xexample.org/es/",
       "ftp://a.b://c.com/fr/", "http://É.Com/de/ü#/fr/", "http://org/x", "http://example.org:80/es/", "http://user@x.com/fr/", "x\ny://q.com/de/\nz?", "http://x.com/fr", "http://a.com?/fr/", "http://com/de/" + "ab" * 30_000, "http://comx/fr/"]


def corpus():
    rng = random.Random(4)
    rows = [f"http://{rng.choice(['a', 'bb', 'www.c'])}.{rng.choice(['org', 'com', 'net'])}/{rng.choice(['fr', 'de', 'en', 'es'])}/{rng.randint(1, 400)}{rng.choice(['', '/', '#top', '.html'])}" for _ in range(500)]
    rows += [rows[0]] * 200 + ORG
    return list(enumerate(rows))


def read(url):
    at = (url or "").find("://")
    rest = "" if at < 0 else url[at + 3 :]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    stop = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    return host, rest[end:stop]


def ruled(host, path):
    fits = [(r, v) for r, v in U.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits, key=lambda x: len(x[0]), default=(None, None))


def symbols(url):
    return [0] * U.ORDER + [b + 1 for b in (url or "").encode().lower()] + [U.END]


def brute(rows, share):
    """Scores by dictionaries, from the definition."""
    training = {True: Counter(), False: Counter()}
    totals = Counter()
    held = []
    for _, url in rows:
        rule, verdict = ruled(*read(url))
        if rule is None:
            continue
        good = verdict == "allow"
        if zlib.crc32((url or "").encode()) % U.CALIBRATE == 0:
            held.append((good, url))
            continue
        s = symbols(url)
        for t in range(U.ORDER, len(s)):
            totals[good] += 1
            for k in range(1, U.ORDER + 2):
                training[good][tuple(s[t - k + 1 : t + 1])] += 1
    kept = {g: {x: c for x, c in training[g].items() if c >= share * totals[g]} for g in training}
    after = {g: {} for g in kept}
    for g, found in kept.items():
        for x, c in found.items():
            a = after[g].setdefault(x[:-1], [0, 0])
            a[0] += c
            a[1] += 1

    def log(g, s, t):
        p = (kept[g].get((s[t],), 0) + 1) / (totals[g] + U.SYMBOLS)
        for k in range(2, U.ORDER + 2):
            x = tuple(s[t - k + 1 : t + 1])
            if x[:-1] in after[g]:
                total, kinds = after[g][x[:-1]]
                p = (kept[g].get(x, 0) + kinds * p) / (total + kinds)
        return math.log(p)

    def score(url):
        s = symbols(url)
        return sum(log(True, s, t) - log(False, s, t) for t in range(U.ORDER, len(s))) / (len(s) - U.ORDER)

    return score, [(g, score(u)) for g, u in held]


@pytest.mark.parametrize("share", [U.SHARE, 0.002])
def test_judge(spark, share):
    rows = corpus()
    pages = spark.createDataFrame([(i, u, "h", "x", "y", "z", "s") for i, u in rows], SCHEMA).repartition(3)
    got = {r["page_id"]: r for r in U.judge(pages, share=share).collect()}
    assert len(got) == len(rows)
    score, held = brute(rows, share)
    cut = U.learn(pages, share=share).cut
    good, bad = [s for g, s in held if g], [s for g, s in held if not g]
    wrong = lambda c: sum(s < c for s in good) / len(good) + sum(s >= c for s in bad) / len(bad)
    assert wrong(cut) <= min(wrong(k / U.BINS) for k in range(-400, 400)) + 1e-9
    for i, u in rows:
        host, path = read(u)
        rule, verdict = ruled(host, path)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), u
        assert abs(r["score"] - score(u)) < 1e-9
        assert r["verdict"] == (verdict or ("allow" if r["score"] >= cut else "block"))


def test_models_tell_apart(spark):
    """On URLs that taught nothing, the sign of the score against the cut agrees with the rules."""
    rng = random.Random(8)
    url = lambda tld, lang: f"https://{rng.choice(['m', 'www'])}.{''.join(rng.choice('thison') for _ in range(6))}.{tld}/{lang}/{rng.randint(1, 9999)}"
    rows = [url(*rng.choice([("com", "fr"), ("com", "de"), ("org", "en")])) for _ in range(2000)]
    pages = spark.createDataFrame([(i, u, "", "", "", "", "") for i, u in enumerate(rows)], SCHEMA)
    model = U.learn(pages)
    fresh = [(lang, url("net", lang)) for lang in ("fr", "de") for _ in range(200)]
    right = [(s >= model.cut) == (lang == "fr") for (lang, _), s in zip(fresh, model.scores([u for _, u in fresh]), strict=True)]
    assert sum(right) >= 380


def test_one_kind_or_none(spark):
    only = spark.createDataFrame([(1, "http://a.com/fr/1", "", "", "", "", ""), (None, "http://a.net/x", "", "", "", "", "")], SCHEMA)
    assert sorted((str(r["page_id"]), r["verdict"], r["score"]) for r in U.judge(only).collect()) == [("1", "allow", 0.0), ("None", "allow", 0.0)]
    assert U.judge(spark.createDataFrame([], SCHEMA)).count() == 0


def test_kept_ngrams_are_bounded(spark):
    pages = spark.createDataFrame([(i, u, "h", "x", "y", "z", "s") for i, u in corpus()], SCHEMA)
    model = U.learn(pages, share=0.01)
    assert all(len(g) <= 100 for side in (model.accepted, model.rejected) for g in side.grams)
