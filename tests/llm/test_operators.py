"""Each operator against a brute-force version, on a small table with the awkward cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seatledger.llm import decontam, langmodel, license, mixture, neardup, quality, substrings, tokens, toxicity, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, `_sl_text` string, block int, shard int"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def corpus():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(400)] + ["é", "Ünder", "日本", "the", "Of"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base = text(150)
    rows = [(i, text(rng.choice([1, 5, 60, 200]))) for i in range(30)]
    rows += [(100, base), (101, base), (102, base.replace(" the ", " xx ", 1) + " tail end"), (103, "pre fix " + base), (104, base[200:])]
    near = base.split()
    for k in range(6):
        own = list(near)
        own[k * 7] = f"edit{k}"
        rows.append((110 + k, " ".join(own)))
    rows += [(200, None), (201, ""), (202, " \t\n "), (203, "one"), (204, "One"), (205, "a a a a a a"), (206, text(3000)), (207, "x\x01y\x02 \x0bz\x0c"), (208, "l1 a\nl1 a\n\nl2 b\r\nl1 a")]
    rows += [(30, rows[3][1]), (30, rows[3][1]), (None, base), (-5, text(40))]
    rng.shuffle(rows)
    return [(i, t, "en", rng.choice(["b", "a", "é", None, ""]), 0, "w", "t", 1, 2) for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    return [(r[0], r[1], r[3]) for r in corpus()]


def test_quality(docs, none, rows):
    want = []
    for i, t, _ in rows:
        w = WORD.findall(t or "")
        c = Counter(zip(w, w[1:], w[2:]))
        cov = {j + k for j in range(len(w) - 2) if c[tuple(w[j : j + 3])] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        want.append((i, len(w), sum(map(len, w)), sum((t or "").count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(cov), len(w) < 50 or 100 * len(cov) > 50 * len(w)))
    got = quality.report(docs).collect()
    key = lambda r: tuple(-10**9 if x is None else x for x in r)
    assert sorted((tuple(r)[:7] for r in got), key=key) == sorted(want, key=key)
    assert all(not (r["base_failed"] and r["kept"]) for r in got)
    assert quality.report(none).count() == 0
    kept = quality.apply_cascade(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)


def test_quality_sample_and_costs(docs, none):
    assert quality.sample_of(docs, 10**6).count() == docs.count()
    many = docs.sparkSession.range(5000).selectExpr("id doc_id", "'a b' text")
    assert 60 < quality.sample_of(many, 100).count() < 160
    found = quality.estimate(docs, sample_rows=10**6, rounds=1)
    assert {e.rule for e in found} == {r.name for r in quality.RULES} and all(0 <= e.rejected <= 1 and e.seconds >= 0 for e in found)
    assert found == sorted(found, key=lambda e: (-e.worth, e.rule)) and len(quality.estimate(none)) == len(quality.RULES)


def test_quality_order_changes_no_verdict(docs):
    from pyspark.sql import functions as F

    m = quality.metrics(F.col("text"))
    a, b = (docs.where(quality.passes(r, m)).count() for r in (quality.RULES, quality.RULES[::-1]))
    assert a == b


def test_mixture(docs, none, rows):
    got = mixture.mix(docs, least_slots=400).collect()
    assert len(got) == len(rows) and mixture.mix(none).count() == 0
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        w = sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and left * weight[s] / w > 3 * sizes[s]}
        if not over:
            break
        full |= over
    target = {s: 3 * sizes[s] if s in full else left * weight[s] / w for s in order}
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    block = max(1, total // 400)
    for s in order:
        assert abs(taken[s] - target[s]) <= 6 * block
    again = mixture.mix(docs, least_slots=400).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_neardup(docs, none, rows):
    sets = []
    for i, t, _ in rows:
        w = WORD.findall(lower(t))
        sets.append(set(zip(w, w[1:])) if len(w) > 1 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if None not in (rows[a][0], rows[b][0]) and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    comp = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            comp[find(k)] = min(comp.get(find(k), i), i)
    want = Counter((i, len(sets[k]), None if i is None else comp[find(k)]) for k, (i, _, _) in enumerate(rows))
    got = neardup.find(docs).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)
    assert neardup.find(none).count() == 0


@pytest.mark.parametrize("wide,size", [(1 << 24, 32 << 20), (1, 32 << 20), (20, 2000)])
def test_neardup_blocks(spark, monkeypatch, wide, size):
    """Groups larger than a run, regions with several components, orders of greater depth, and sets too large for a run."""
    monkeypatch.setattr(neardup, "RUN", 4)
    monkeypatch.setattr(neardup, "WIDE", wide)
    monkeypatch.setattr(neardup, "BYTES", size)
    rng = random.Random(2)
    rows = []
    for g in range(4):
        words = [f"g{g % 2}w{k}" for k in range(80)] + [f"h{g}x{k}" for k in range(25)]
        for m in range(15):
            own = list(words)
            own[rng.randrange(len(own))] = f"n{g}m{m}"
            rows.append((g * 100 + m, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: set(zip(t.split(), t.split()[1:])) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {r["doc_id"]: r["component_id"] for r in neardup.find(docs).collect()} == {i: find(i) for i in sets}


def test_neardup_runs():
    """Runs cover a region once, in order, and part it where neighbours have least in common."""
    rng = np.random.default_rng(4)
    for n in (1, 5, 6, 40, 500):
        for _ in range(20):
            lcp = rng.integers(4, 9, n)
            runs = neardup.cut_runs(lcp, 5)
            assert runs[0][0] == 0 and runs[-1][1] == n and all(0 < b - a <= 5 for a, b in runs) and all(x[1] == y[0] for x, y in zip(runs, runs[1:]))
    assert neardup.cut_runs(np.array([0, 7, 7, 4, 7, 7, 7]), 4) == [(0, 3), (3, 7)]
    assert neardup.trees_for(4, 80) == 31 and (1 - 0.8**4) ** 31 < neardup.MISS


def test_neardup_recall(spark):
    """Pairs of similarity just over 0.8, each in a place of its own: every one is found."""
    rng = random.Random(7)
    rows = []
    for g in range(300):
        words = [f"g{g}w{k}" for k in range(101)]
        other = list(words)
        for k in rng.sample(range(1, 100, 5), 5):  # ten of a hundred shingles change: 90 of 110 are common
            other[k] = f"x{g}y{k}"
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(other))]
    got = {r["doc_id"]: r["component_id"] for r in neardup.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[2 * g + 1] == 2 * g for g in range(300)) == 300


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 400)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r["node"]: r["root"] for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(x, x) == find(x) for x in root)


def _removed(rows):
    where = {}
    for k, (_, t, _) in enumerate(rows):
        b = (t or "").encode()
        for p in range(len(b) - 399):
            where.setdefault(b[p : p + 400], []).append((k, p))
    gone = [bytearray(len((t or "").encode())) for _, t, _ in rows]
    for places in where.values():
        if len(places) > 1:
            for k, p in places:
                gone[k][p : p + 400] = b"\x01" * 400
    return gone


@pytest.mark.parametrize("crowded", [False, True])
def test_substrings(docs, none, rows, monkeypatch, crowded):
    if crowded:
        monkeypatch.setattr(substrings, "MOST_REGIONS", 1)
    want = Counter()
    for (i, t, _), gone in zip(rows, _removed(rows), strict=True):
        b = (t or "").encode()
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        want[i, len(b), len(b) - len(kept), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()] += 1
    assert any(k[2] and k[2] < k[1] for k in want)
    assert Counter(tuple(r) for r in substrings.dedup(docs).drop("kept").collect()) == want
    assert substrings.dedup(none).count() == 0


def test_substrings_periodic(spark):
    """Runs of one byte and short periods, where anchors tie."""
    rows = [(1, "a" * 900, ""), (2, "ab" * 450 + "x" * 10, ""), (3, "zyx" * 200, ""), (4, "q" * 399, ""), (5, "r" * 400, ""), (6, "é" * 300, "")]
    got = {r["doc_id"]: r["n_removed"] for r in substrings.dedup(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    assert got == {i: sum(g) for (i, _, _), g in zip(rows, _removed(rows), strict=True)}


def test_substrings_frequent(spark):
    """The rows of a very frequent region do not meet in one task."""
    shared = spark.range(6000, numPartitions=8).select(F.when(F.col("id") < 5000, 1).otherwise(F.col("id") % 700 + 2).alias("fp"), F.lit(7).alias("region"), "id")
    kinds = shared.groupBy("fp", "region").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the repeated regions were too many to send
    try:
        rows = substrings.repeated(shared, kinds).select("id", "fp", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    often = Counter(1 if i < 5000 else i % 700 + 2 for i in range(6000))
    assert sorted(r["id"] for r in rows) == [i for i in range(6000) if often[1 if i < 5000 else i % 700 + 2] > 1]
    assert max(Counter(r["task"] for r in rows if r["fp"] == 1).values()) <= 1000


def test_substrings_slices(spark, monkeypatch):
    """Slices that share their bytes but differ at the ends in very many ways are not sorted in one bucket."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    common = text(394)
    rows = [(i, text(rng.randint(1, 60)) + rng.choice(["", "a", "bb", "ccc", "dddd"]) + common + rng.choice(["", "e", "ff", "ggg"]) + text(rng.randint(1, 60)), "") for i in range(60)]
    rows += [(100 + i, text(30) + "abc" + common + "hgfe" + text(30), "") for i in range(3)]
    monkeypatch.setattr(substrings, "MOST_REGIONS", 1)
    monkeypatch.setattr(substrings, "MOST_SLICES", 1, raising=False)

    def unsorted(rows):
        raise AssertionError("sorted in one bucket")

    monkeypatch.setattr(substrings, "_sort_bucket", unsorted)
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"], r["kept"]) for r in substrings.dedup(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    want = {i: (sum(g), len(re.findall(b"\x01+", bytes(g))), bytes(x for x, y in zip(t.encode(), g, strict=True) if not y)) for (i, t, _), g in zip(rows, _removed(rows), strict=True)}
    assert len({n for n, _, _ in want.values()}) > 3
    assert got == want


def test_substrings_of_over_50_words(spark):
    """Over 50 words that repeat in 399 bytes stay, by the contract; 400 bytes go."""
    words = " ".join(f"w{k:05d}" for k in range(57))
    for n in (399, 400):
        passage = words.ljust(400, "z")[:n]
        assert len(passage.split()) > 50
        docs = spark.createDataFrame([(1, "a" + passage + "b"), (2, "c" + passage + "d")], "doc_id long, text string")
        assert {r["n_removed"] for r in substrings.dedup(docs).collect()} == {n // 400 * 400}


def test_suffix_order():
    rng = random.Random(1)
    for trial in range(200):
        t = np.array([rng.choice([97, 97, 98, 99][: 2 + trial % 3]) for _ in range(rng.randint(1, 150))], np.uint8)
        wanted = np.array([rng.random() < 0.6 for _ in t])
        raw = t.tobytes()
        order = sorted(np.flatnonzero(wanted).tolist(), key=lambda i: raw[i:])
        assert substrings.suffix_order(t, wanted).tolist() == order
        for x, y, k in zip(order, order[1:], substrings.common_prefixes(t, np.array(order, dtype=np.int64)) if len(order) > 1 else [], strict=False):
            e = 0
            while max(x, y) + e < len(raw) and raw[x + e] == raw[y + e]:
                e += 1
            assert k == e


@pytest.mark.parametrize("order,block", [(2, 1 << 24), (3, 1 << 24), (3, 4000), (4, 4000)])
def test_langmodel(docs, none, rows, order, block):
    texts = [WORD.findall(lower(t)) + [None] for _, t, _ in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _, _ in rows]
    c = {n: Counter() for n in range(1, order + 1)}
    gram = lambda t, j, n: tuple((["<s>"] * n + t)[j + n - n + 1 : j + n + 1])
    for t, h in zip(texts, held, strict=True):
        if not h:
            for j in range(len(t)):
                for n in c:
                    c[n][gram(t, j, n)] += 1
    total, kinds, n_texts = sum(c[1].values()), len(c[1]), held.count(False)
    share = {n: min(0.99, max(0.01, sum(v == 1 for v in c[n].values()) / sum(c[n].values()))) for n in c}
    want = []
    for (i, _, _), t, h in zip(rows, texts, held, strict=True):
        score = 0.0
        for j in range(len(t)):
            p = (c[1][(t[j],)] + 1) / (total + kinds + 1)
            for k in range(1, order):
                hist = n_texts if j == 0 else c[k][gram(t, j - 1, k)]
                p = ((1 - share[k + 1]) * c[k + 1][gram(t, j, k + 1)] + (langmodel.MU + share[k + 1] * hist) * p) / (hist + langmodel.MU)
            score += math.log10(p)
        base = sum(math.log10((c[1][(w,)] + 1) / (total + kinds + 1)) for w in t)
        want.append((-10**9 if i is None else i, h, len(t), sum(c[1][(w,)] > 0 for w in t), total, round(base, 6), round(score, 6)))
    got = [(-10**9 if r[0] is None else r[0], *r[1:5], round(r[5], 6), round(r[6], 6)) for r in map(tuple, langmodel.score(docs, order, block).collect())]
    for x, y in zip(sorted(got), sorted(want), strict=True):
        assert x[:5] == y[:5] and x[5:] == pytest.approx(y[5:], abs=2e-6)
    assert langmodel.score(none).count() == 0


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_langmodel_sums_to_one(order):
    """From every state, the words and one unknown hold all probability, over arcs and failure arcs."""
    texts = ["a b a c", "a b", "", "b b b a c c"]
    toks = langmodel.Tokens([*texts, "unknown"], neardup.WordHashes())
    counts, grams = {}, {}
    for n in range(1, order + 1):
        keys, last, where = np.unique(toks.grams(n), return_index=True, return_inverse=True)
        learn = np.arange(len(toks.hashes)) < toks.begins[-1]
        counts[n] = np.bincount(where, weights=learn, minlength=len(keys)).astype(np.int64)
        grams[n] = last, where
    total, kinds = int(counts[1].sum()), int((counts[1] > 0).sum())
    model = langmodel.Automaton(toks, order, counts, grams, total, kinds, len(texts), {n: 0.4 for n in range(2, order + 1)})
    words = np.arange(model.words)
    ends = {int(model.word[toks.begins[i] + toks.lengths[i] - 1]) for i in range(len(texts))}
    for state in range(len(model.fail)):
        # A history that ends a text is followed by nothing, so its share of count is not given out.
        if all(model.targets[np.searchsorted(model.arcs, s * model.words + w)] != state for s in range(len(model.fail)) for w in ends if s * model.words + w in set(model.arcs.tolist())):
            cost, _ = model.step(np.full(model.words, state), words)
            assert (10**cost).sum() == pytest.approx(1.0)
    # The state after a text is the longest history that the corpus has, whatever the segment it was entered in.
    for segment in (1, 2, 128):
        langmodel.SEGMENT, held = segment, langmodel.SEGMENT
        try:
            logs = langmodel.walk(toks, model)
        finally:
            langmodel.SEGMENT = held
        assert logs == pytest.approx(langmodel.walk(toks, model))


def test_langmodel_tokenises_once(docs, rows):
    """Requests and scores read token numbers: no text is left in the plan, and the numbers give the same n-grams."""
    plan = langmodel.score(docs, 3, 2000)._jdf.queryExecution().analyzed().toString()
    assert "text#" not in plan and "vocabulary#" in plan
    toks = langmodel.Tokens([t for _, t, _ in rows], neardup.WordHashes())
    again = langmodel.Tokens.stored(toks.lengths, langmodel.unpack(langmodel.pack(toks.vocabulary)), langmodel.unpack_counts(langmodel.pack_counts(toks.words)))
    assert (again.hashes == toks.hashes).all() and (again.begins == toks.begins).all()
    for n in (1, 2, 3):
        for x, y in zip(again.distinct(n), np.unique(toks.grams(n), return_inverse=True), strict=True):
            assert (x == y).all()


def test_packing():
    x = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2))
    assert (langmodel.unpack(langmodel.pack(x)) == x).all()
    assert (langmodel.unpack_counts(langmodel.pack_counts(np.arange(300))) == np.arange(300)).all()


def test_tokens_round_trip(docs, none, rows, tmp_path, spark):
    out = f"file://{tmp_path}/out"
    manifest = tokens.write(docs, out, length=64, shard_slots=16)
    got = tokens.read(spark, out).collect()
    assert sorted(r["slot"] for r in got) == list(range(manifest["total"]))
    assert all(r["byte_offset"] == (r["slot"] % 16) * tokens.stride(64) and r["shard"] == r["slot"] // 16 for r in got)
    encoder = tokens.load_encoder(tokens.vocabulary_path())
    texts = {i: t or "" for i, t, _ in rows}
    once = Counter(i for i, _, _ in rows)
    for i in texts:
        if once[i] == 1:
            parts = sorted((r["part"], r["tokens"]) for r in got if r["doc_id"] == i)
            ids = np.frombuffer(b"".join(p for _, p in parts), np.uint16)
            assert ids[-1] == tokens.END and encoder.decode(ids[:-1].tolist()) == texts[i]
    # The bytes of a slot, by one seek in a flat file.
    for r in got[::17]:
        wave, part = divmod(r["shard"], tokens.layout(manifest["total"], 64, 16)[2])
        (name,) = (tmp_path / "out/shards").glob(f"wave-{wave:02d}/part-{part:05d}-*")
        with open(name, "rb") as f:
            f.seek(r["byte_offset"])
            raw = f.read(tokens.stride(64))
        head = np.frombuffer(raw[: tokens.HEADER.itemsize], tokens.HEADER)[0]
        assert head["slot"] == r["slot"] and raw[tokens.HEADER.itemsize :][: 2 * r["n_tokens"]] == r["tokens"] and raw.endswith(b"\r\n")
    later = tokens.read(spark, out, first_slot=40).collect()
    assert sorted(later, key=lambda r: r["slot"]) == sorted((r for r in got if r["slot"] >= 40), key=lambda r: r["slot"])
    name = sorted((tmp_path / "out/shards").glob("*/part-00001-*"))[0]
    whole = name.read_bytes()
    for bad in (whole[:-1], whole[:100] + bytes([whole[100] ^ 1]) + whole[101:]):
        name.write_bytes(bad)
        (name.parent / f".{name.name}.crc").unlink(missing_ok=True)
        with pytest.raises(Exception, match="is damaged"):
            tokens.read(spark, out).collect()
    name.unlink()
    with pytest.raises(ValueError, match="ranges"):
        tokens.read(spark, out)
    assert tokens.materialised_order(none).count() == 0


def test_tokens_slot_order(docs, tmp_path, spark):
    """Each slot holds the sequence whose number the permutation sends there."""
    out = f"file://{tmp_path}/out"
    total = tokens.write(docs, out, length=64, shard_slots=16)["total"]
    stored, first, want = spark.read.parquet(f"{out}/tokens").collect(), 0, {}
    for task in sorted({r["task"] for r in stored}):
        own = sorted((r for r in stored if r["task"] == task), key=lambda r: r["first"])
        for r in own:
            for part in range(-(-r["n_tokens"] // 64)):
                want[int(tokens.permute(np.array([first + r["first"] + part]), total)[0])] = (r["doc_id"], part, r["tokens"][128 * part : 128 * part + 128])
        first += sum(-(-r["n_tokens"] // 64) for r in own)
    assert {r["slot"]: (r["doc_id"], r["part"], r["tokens"]) for r in tokens.read(spark, out).collect()} == want


def test_tokens_resume(docs, spark, tmp_path, monkeypatch):
    """A run that fails midway keeps the ranges that it finished; the next one adds the rest and nothing else."""
    from pyspark.sql import functions as F

    out = f"file://{tmp_path}/out"
    whole = f"file://{tmp_path}/whole"
    total = tokens.write(docs, whole, length=64, shard_slots=16)["total"]
    stored = spark.read.parquet(f"{whole}/tokens")
    offsets, n = tokens.numbering(stored, 64)
    assert n == total
    for name in ("tokens", "manifest"):
        (spark.read.parquet if name == "tokens" else spark.read.text)(f"{whole}/{name}").write.format("parquet" if name == "tokens" else "text").save(f"{out}/{name}")
    # The task of the last range fails when the first ones have ended.
    filled = F.rpad
    with monkeypatch.context() as m, pytest.raises(Exception, match="lost"):
        m.setattr(F, "rpad", lambda record, n, fill: F.when(F.col("slot") == total - 1, F.raise_error(F.lit("lost")).cast("binary")).otherwise(filled(record, n, fill)))
        tokens.write_shards(lambda a, b: tokens.sequences(stored, offsets, n, 64, first=a, end=b), spark, total, f"{out}/shards", 64, 16)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out/shards").glob("*/part-*")}
    tokens.write(docs, out, length=64, shard_slots=16)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "out/shards").glob("*/part-*")}
    assert before and len(before) < len(after) and before.items() <= after.items()
    # A finished range is not written again.
    sorted(after)[0].unlink()
    tokens.write(docs, out, length=64, shard_slots=16)
    last = {p: p.stat().st_mtime_ns for p in (tmp_path / "out/shards").glob("*/part-*")}
    assert len(last) == len(after) and len(last.items() & after.items()) == len(after) - 1
    key = lambda r: r["slot"]
    assert sorted(tokens.read(spark, out).collect(), key=key) == sorted(tokens.read(spark, whole).collect(), key=key)
    with pytest.raises(ValueError, match="other input"):
        tokens.write(docs.where("doc_id <> 5"), out, length=64, shard_slots=16)
    with pytest.raises(ValueError, match="other input"):
        tokens.write(docs, out, length=64, shard_slots=16, key=1)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutation(n):
    x = np.arange(n)
    y = tokens.permute(x, n)
    assert sorted(y.tolist()) == x.tolist() and (tokens.permute(y, n, back=True) == x).all()
    if n == 1000:
        assert (y != tokens.permute(x, n, key=1)).any() and abs(np.corrcoef(x, y)[0, 1]) < 0.2


def test_decontam(spark, none):
    rng = random.Random(4)
    vocab = [f"w{k}" for k in range(3000)] + ["the", "of", "and"] * 200
    sentence = lambda n: " ".join(rng.choice(vocab) for _ in range(n)) + "."
    items = [(k, sentence(20) + " " + sentence(8)) for k in range(60)] + [(60, sentence(150)), (61, items_none := None), (62, ""), (63, "the of and.")]
    assert items_none is None
    docs = []
    for k in range(60):
        text = sentence(300).split()
        if k % 3 == 0:
            text[137:137] = items[k][1].split()
        if k % 3 == 1:
            text[40:40] = items[k][1].split()[:12]  # too little of it
        docs.append((k, " ".join(text)))
    docs += [(100, "x " + items[60][1].upper() + " y"), (101, None), (102, ""), (None, items[0][1])]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find(d, b).collect()}
    assert {g for g in got if g[1] != 63} == {(k, k) for k in range(0, 60, 3)} | {(100, 60), (None, 0)}
    assert decontam.clean(d, b.where("item_id <> 63")).count() == len(docs) - 22
    assert decontam.find(none, b).count() == 0 and decontam.find(d, b.limit(0)).count() == 0
    assert decontam.clean(d, b.limit(0)).count() == len(docs)


def test_decontam_shards_change_nothing(spark, monkeypatch):
    """Scores rest on the statistics of all items, however many shards these are dealt into."""
    rng = random.Random(14)
    vocab = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.randint(10, 150))) + ".") for k in range(50)]
    docs = [(k, " ".join([*rng.choices(vocab, k=90), items[k][1], *rng.choices(vocab, k=90)])) for k in range(50)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    rows = lambda: sorted((r["doc_id"], r["item_id"], round(r["score"], 9)) for r in decontam.find(d, b).collect())
    whole = rows()
    split = decontam.shards
    monkeypatch.setattr(decontam, "shards", lambda items: split(items, 4_000))
    assert len(list(decontam.shards(b))) > 3 and rows() == whole and len(whole) >= 50


def test_wand_is_exact():
    rng = random.Random(6)
    vocab = [f"t{k}" for k in range(60)]
    index = decontam.Index([(k, " ".join(rng.choice(vocab) for _ in range(rng.randint(3, 30)))) for k in range(400)])
    for _ in range(40):
        query = set(rng.sample(vocab, rng.randint(1, 40)))
        for threshold in (0.2, 0.5, 0.8):
            want = {}
            for t in query & set(index.lists):
                for n, v in zip(*index.lists[t][:2], strict=True):
                    want[n] = want.get(n, 0) + v
            want = {n: v for n, v in want.items() if v >= threshold}
            got = dict(index.wand(query, threshold))
            assert got.keys() == want.keys() and all(got[n] == pytest.approx(want[n]) for n in got)


def test_license(docs, none, spark):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    texts = ["Released under the MIT License.", "mit-license; MIT LICENSE mit\nlicense", "GNU General Public License version 3", "the lesser general public license", "apache license apache license", "nothing", None, "", "É mit license", "licensed under CC BY-NC 4.0", "SPDX-License-Identifier: Apache-2.0"]
    got = {r["doc_id"]: r for r in license.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        w = word.findall(lower(t))
        starts = [(k, label) for p, label in ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl")) for k in range(len(w)) if tuple(w[k : k + len(p)]) == p]
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(w), len(starts), min((s for s, _ in starts), default=None), max((s for s, _ in starts), default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in starts})) and {x for _, x in starts} <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1
    assert got[9]["labels"] == "cc-by-nc" and got[10]["labels"] == "apache" and got[3]["labels"] == "gpl,lgpl"
    assert license.scan(docs).count() == docs.count() and license.scan(none).count() == 0


def test_license_suppression():
    tools = license.matcher()
    found = license.detect("SPDX-License-Identifier: GPL-2.0-only", tools)
    assert {d[2] for d in found} == {"gpl"} and not any(a is not b and a[0] <= b[0] and b[1] <= a[1] and a[3] >= b[3] for a in found for b in found)
    assert len(tools[0]) > 400


def test_license_rules_are_bounded():
    """No rule reaches beyond its window, and each holds its keyword, so windows and prefilter lose nothing."""
    for s in license.signatures():
        assert re._parser.parse(license.flexible(s.pattern)).getwidth()[1] < license.REACH, s
        word = max(s.keyword.split(" "), key=len)
        assert word == "licen" or word in s.pattern.replace("\\", "").replace("licen[sc]e", "license"), s


@pytest.mark.parametrize("seed", range(4))
def test_license_equals_a_scan_of_the_whole_text(seed):
    """Every rule over the whole folded text, with no keywords and no windows."""
    rng = random.Random(seed)
    tools = license.matcher()
    pieces = ["MIT License", "licensed under the Apache License, Version 2.0", "gpl-3.0-or-later", "SPDX-License-Identifier: (MIT OR\tISC) AND xx", "\n", "   ", "\t\n ", "all rights reserved", "É", "K", "copyright (c) 2001", "word " * 80,
              "see the license for the specific language governing permissions and" + " " * 500 + "\nlimitations under the license", "permission is hereby granted, free\n of charge, to any person obtaining a copy", "creative commons attribution-share alike license", "license:", "cc by-nc 4.0", "x" * 390]
    for _ in range(60):
        text = " ".join(rng.choice(pieces) for _ in range(rng.randint(1, 25)))
        folded = license.Folded(text)
        want = list(license._tagged(folded.text, [m.end() for m in re.finditer(license.SPDX_TAG, folded.text)], tools[2]))
        for s, rx in tools[0]:
            want += [(m.start(), m.end(), s.label, s.priority, s.weight) for m in rx.finditer(folded.text)]
        assert sorted(license.candidates(folded.text, tools)) == sorted(want)
        assert all(re.sub(r"\s+", " ", folded.lower[a:b]) == re.sub(r"\s", " ", folded.text[c:d]) for (a, b, *_), (c, d, *_) in zip(license.detect(text, tools), license.suppress(want), strict=True))


def test_license_far_from_its_keyword():
    tools = license.matcher()
    for n in (5, 150, 40_000):
        assert "vim" in {d[2] for d in license.detect("SPDX-License-Identifier: " + " or ".join(["xx"] * n) + " or Vim", tools)}
    for gap in (1, 500, 300_000):
        assert {d[2] for d in license.detect("See the License for the specific language governing permissions and" + " " * gap + "limitations under the License", tools)} == {"apache"}
    assert license.scan_text("\u212a MIT LICENSE" + " word" * 300_000, tools)["n_words"] == 300_003


def test_toxicity(docs, none, spark):
    rng = random.Random(8)
    clean = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(clean) for _ in range(80)]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(5):
                words[rng.randrange(80)] = rng.choice(["grobnik", "grobnaj", "grobnul", "grobnec", "idiot"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    d, y = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    lexicon = toxicity.learn(d, y)
    assert {"grobnik", "grobnaj", "grobnul", "grobnec"} <= set(lexicon.weights)
    out = {r["doc_id"]: r for r in toxicity.score(d, lexicon).collect()}
    held = [r for i, r in out.items() if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    assert held and all(r["predicted"] == (r["doc_id"] % 5 == 0) == (r["score"] >= 0.3) for r in held)
    assert toxicity.score(docs, lexicon).where("predicted = 1").count() == 0
    assert toxicity.score(none, lexicon).count() == 0
    bare = toxicity.learn(none, y)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(spark.createDataFrame([(1, "you 1d10t, ѕtupid scum"), (2, "pond scum in a trash can"), (3, None), (4, "")], "doc_id long, text string"), bare).collect()}
    assert got == {1: 1, 2: 0, 3: 0, 4: 0}


def test_warc(spark):
    long = "é<p>" * 60
    rows = [(5, "http://a/", long), (3, "http://b/\r\n", long), (9, None, long), (4, "u", "short"), (6, "u", "short"), (7, "u", None), (8, "u", ""), (None, "u", long), (3, "again", long), (10, "u", "x" * 100), (11, "u", "x" * 100), (12, "u", "y" * 99), (13, "u", "y" * 99)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    got = Counter(tuple(r) for r in warc.read_archives(warc.write(pages)).collect())
    want = Counter()
    for i, _, h in rows:
        b = (h or "").encode()
        again = len(b) >= 100 and i is not None and i != (3 if h == long else 10)
        want[i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", (3 if h == long else 10) if again else None] += 1
    assert got == want
    assert warc.read_archives(warc.write(pages.limit(0))).count() == 0


def test_warc_damage(tmp_path, spark):
    rng = random.Random(1)
    payloads = [("<html>" + " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(200))).encode() for _ in range(50)]
    dictionary = warc.train(payloads, 1024)
    w = warc.Writer(dictionary.as_bytes() if dictionary else None)
    for i, p in enumerate(payloads):
        w.add(warc.record_bytes(i, "u", p, hashlib.sha256(p).hexdigest(), "response", None))
    data = w.take()
    assert [r.payload for r in warc.read(data)] == payloads
    (tmp_path / "a.warc.zst").write_bytes(data)
    assert warc.read_files(spark, f"file://{tmp_path}").count() == 50
    for bad in (data[:-3], data[: len(data) // 2], data + b"x", data[:-1] + bytes([data[-1] ^ 1]), b"junk"):
        with pytest.raises(ValueError):
            list(warc.read(bad))
    good = warc.record_bytes(1, "u", b"p", hashlib.sha256(b"p").hexdigest(), "response", None)
    for bad in (re.sub(rb"Content-Length: (\d+)", lambda m: b"Content-Length: %d" % (int(m[1]) + 1), good, count=1), good.replace(b"WARC/1.1", b"WRC/1.1"), good.replace(b"\r\n\r\np", b"\r\n\r\nq"), good.replace(b"WARC-Date", b"X-Date")):
        with pytest.raises(ValueError):
            warc.parse(bad)


def test_warc_long_archive():
    """Reading takes time in proportion to the records, and a record may be far longer than a slice."""
    import time

    body = random.Random(2).randbytes(150)

    def seconds(n):
        w = warc.Writer(None)
        for i in range(n):
            w.add(warc.record_bytes(i, "u", body, hashlib.sha256(body).hexdigest(), "response", None))
        data = w.take()
        began = time.perf_counter()
        assert sum(1 for _ in warc.read(data)) == n
        return time.perf_counter() - began

    seconds(500)
    assert seconds(16_000) < 24 * seconds(2_000)
    long = random.Random(3).randbytes(3 << 20)
    w = warc.Writer(None)
    for i in range(3):
        w.add(warc.record_bytes(i, "u", long, hashlib.sha256(long).hexdigest(), "response", None))
    assert [r.payload for r in warc.read(w.take())] == [long] * 3


LONG = 60_000


def long_docs(spark):
    """Texts of some hundred thousand words and of one endless word, twice each, beside short ones."""
    rng = random.Random(21)
    many = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(9000)) for _ in range(LONG))
    rows = [(1, many), (2, many), (3, many + " tail"), (4, "x" * 300_000), (5, "x" * 300_000), (6, "idiot " * LONG), (7, "\n" * 100_000), (8, "mit license"), (9, None), (9, None), (9, "one two three")]
    names = "doc_id long, text string, source string, block int, shard int, slot long, id long, items string, sig string, tree int, key string, prefix long, job string, comp long, term string, `_sl_id` string, `_sl_source` string, `_sl_hash` long, `_sl_share` double, `_sl_copies` int, `_sl_row` int, component_id long, taken long, `_sl_q_text_ok` long, bucket int, rank int, task int, part int, record string"
    return spark.createDataFrame([(i, t, "s", 1, 2, 3, 4, "5", "6", 7, "8", 9, "a", 1, "b", "c", "d", 2, 0.5, 3, 4, 5, 6, 7, 8, 9, 1, 2, "r") for i, t in rows], names), rows


def test_long_texts_and_clashing_columns(spark, tmp_path):
    docs, rows = long_docs(spark)
    n = len(rows)
    by = lambda frame, *cols: Counter(tuple(r[c] for c in cols) for r in frame.collect())
    words = Counter((i, len(WORD.findall(t or ""))) for i, t in rows)
    assert by(quality.report(docs), "doc_id", "n_words") == words
    assert by(langmodel.score(docs), "doc_id", "n_tokens") == Counter((i, k + 1) for (i, k), c in words.items() for _ in range(c))
    assert by(mixture.mix(docs), "doc_id", "size") == words
    found = {r["doc_id"]: r["component_id"] for r in neardup.find(docs).collect() if r["doc_id"] != 9}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7, 8: 8}
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"]) for r in substrings.dedup(docs).collect() if r["doc_id"] != 9}
    assert got[4] == (300_000, 300_000) == got[5] and got[1][0] == got[1][1] and got[3][1] == got[1][0] and got[8] == (11, 0)
    scanned = {r["doc_id"]: (r["n_words"], r["n_base"]) for r in license.scan(docs).collect()}
    assert scanned[8] == (2, 1) and scanned[4] == (1, 0) and scanned[1][0] == LONG
    toxic = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, toxicity.Lexicon(dict(toxicity.WORDS), toxicity.FIXED_CURVE)).collect()}
    assert toxic[6] == 1 and toxic[1] == 0
    items = spark.createDataFrame([(1, rows[0][1][-400:].split(" ", 1)[1])], "item_id long, text string")
    assert {r["doc_id"] for r in decontam.find(docs, items).collect()} == {1, 2, 3} and decontam.clean(docs, items).count() == n - 3
    assert decontam.clean(docs, items).columns == docs.columns
    kept = neardup.dedup(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 6, 7, 8, 9, 9, 9]
    mixed = mixture.mixed(docs)
    assert mixed.columns == docs.columns and {r["doc_id"] for r in mixed.collect()} <= set(range(1, 10))
    out = f"file://{tmp_path}/out"
    total = tokens.write(docs, out)["total"]
    read = tokens.read(spark, out).groupBy("doc_id").sum("n_tokens").collect()
    assert total > 500 and {r["doc_id"] for r in read} == set(range(1, 10))


def test_repeated_rows_and_empty_tables(spark):
    rows = [(1, "a b c d e f g h i j k l", "s")] * 3 + [(2, "q r s t u v w x y z a b", None)] * 2 + [(None, None, None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    items = spark.createDataFrame([(5, "a b c d e f g h i j k l")] * 2, "item_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontam.find(docs, items).collect()) == [(1, 5)] * 6
    assert Counter(r["doc_id"] for r in decontam.clean(docs, items).collect()) == {2: 2, None: 2}
    assert Counter(r["doc_id"] for r in neardup.dedup(docs).collect()) == {1: 1, 2: 1, None: 2}
    assert {r["doc_id"] for r in mixture.mixed(docs).collect()} <= {1, 2}
    empty = docs.limit(0)
    assert decontam.clean(empty, items).count() == neardup.dedup(empty).count() == mixture.mixed(empty).count() == quality.apply_cascade(empty).count() == 0


def test_mixture_takes_what_its_slots_hold(spark):
    """Words that each row gives, against the schedule walked slot by slot on the driver."""
    from pyspark.sql import functions as F

    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(1, 60)), rng.choice("abcd")) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixture.mix(docs, block_words=16, least_slots=1).collect()
    sources = {s["source"]: s for s in mixture.sources_of(spark.createDataFrame([(r["source"], r["size"]) for r in got], "source string, size long")).collect()}
    total = sum(r["size"] for r in got)
    slots = -(-total // 16)
    order = sorted(sources.values(), key=lambda s: s["sid"])
    points = [r["x"] for r in spark.range(slots).select("id", mixture.point(F.col("id")).alias("x")).orderBy("id").collect()]
    bounds, acc, weight = [], 0.0, sum(s["target"] for s in order)
    for s in order:
        acc += s["target"] / weight
        bounds.append((acc, s["source"]))
    ranks = Counter(next((name for hi, name in bounds if x < hi), bounds[-1][1]) for x in points)
    for name, s in sources.items():
        want = min(16 * ranks[name], 3 * s["source_size"])
        assert abs(sum(r["taken"] for r in got if r["source"] == name) - want) <= 16
        # Blocks are taken from the front of the repeated stream: no row is more than one pass ahead of another.
        shares = [r["taken"] / r["size"] for r in got if r["source"] == name]
        assert max(shares) - min(shares) <= 1 + 1e-9 or min(r["size"] for r in got if r["source"] == name) < 16
