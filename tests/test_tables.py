"""Operators that keep state, an index or a layout of their own, against plain versions of themselves."""

from __future__ import annotations

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from seatledger.functions import text as T
from seatledger.operators import intervals, nearest, search
from seatledger.sources import arrayfile, pages, versioned, xmltable
from seatledger.sources.shared import get, put
from seatledger.streaming import eventtime


class _Map(dict):
    """A map state that counts what is read."""

    reads = 0

    def containsKey(self, k):
        self.reads += 1
        return k in self

    def getValue(self, k):
        self.reads += 1
        return self[k]

    def updateValue(self, k, v):
        self[k] = v

    def removeKey(self, k):
        self.pop(k)

    def keys(self):
        for k in list(dict.keys(self)):
            self.reads += 1
            yield k


class _Handle:
    def __init__(self):
        self.maps, self.timers, self.value = {}, set(), None

    def getMapState(self, name, *_):
        return self.maps.setdefault(name, _Map())

    def getValueState(self, *_):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, v):
        self.value = v

    def registerTimer(self, at):
        self.timers.add(at)


class _Mark:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at


def test_roster_state_reads_with_the_batch():
    """A row that adds to a roster of ten thousand reads its own entries, and so does one that confirms them."""
    handle, state = _Handle(), eventtime.RosterState()
    state.init(handle)
    row = lambda at, full, ids: {"at_ms": at, "is_full": full, "identities": ids}
    everybody = [f"m{i}" for i in range(10_000)]
    list(state.handleInputRows(("r", 0), iter([row(10, True, everybody)]), _Mark(0)))
    assert len(list(state.handleExpiredTimer(("r", 0), _Mark(20), None))) == 10_000
    members = handle.maps["members"]
    members.reads = 0
    list(state.handleInputRows(("r", 0), iter([row(30, False, ["new"])]), _Mark(20)))
    assert [r["identity"] for r in state.handleExpiredTimer(("r", 0), _Mark(40), None)] == ["new"] and members.reads <= 2
    list(state.handleInputRows(("r", 0), iter([row(50, True, everybody)]), _Mark(40)))
    assert [(r["change"], r["identity"]) for r in state.handleExpiredTimer(("r", 0), _Mark(60), None)] == [("removal", "new")]
    assert list(state.handleExpiredTimer(("r", 0), _Mark(70), None)) == []
    assert [r["change"] for r in state.handleInputRows(("r", 0), iter([row(60, True, ["x"]), row(60, True, [])]), _Mark(60))] == ["late", "late"]


def test_event_time_restart(spark, tmp_path):
    """Rows in any order, in two runs with one checkpoint: the changes of the rows in order, and late rows aside."""
    rows = [("a", 1, True, ["x", "y"]), ("a", 2, False, ["q"]), ("a", 3, True, ["y", "z"]), ("a", 5, True, []), ("b", 4, True, ["k"])]
    schema = "roster string, bucket int, at timestamp, is_full boolean, identities array<string>"

    def land(*found):
        data = [(r, 0, datetime.datetime(2020, 1, d), f, i) for r, d, f, i in found]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        eventtime.run(spark, spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "10 days", f"{tmp_path}/out", f"{tmp_path}/cursor")

    land(rows[2], rows[0], rows[4])
    run()
    land(rows[3], rows[1], ("", 28, True, []))
    run()
    land(("a", 2, True, ["w"]))
    run()
    got = sorted((r["roster"], r["at"].day, r["change"], r["identity"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [("a", 1, "addition", "x"), ("a", 1, "addition", "y"), ("a", 2, "addition", "q"), ("a", 2, "late", "w"), ("a", 3, "addition", "z"), ("a", 3, "removal", "q"), ("a", 3, "removal", "x"), ("a", 5, "removal", "y"), ("a", 5, "removal", "z"), ("b", 4, "addition", "k")]


def _edits(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


@pytest.mark.parametrize("k", [0, 1, 2])
def test_near_pairs(spark, k):
    rng = random.Random(k)
    make = lambda n: ["".join(rng.choice("abé") for _ in range(rng.randint(0, 6))) for _ in range(n)]
    words, terms = make(40), make(40)
    frame = lambda x, c: spark.createDataFrame([(w,) for w in x], f"{c} string")
    got = {(r["word"], r["term"], r["dist"]) for r in nearest.near_pairs(frame(words, "word"), frame(terms, "term"), k).collect()}
    assert got == {(a, b, _edits(a, b)) for a in words for b in terms if _edits(a, b) <= k}


def test_containing(spark):
    rng = random.Random(1)
    day = lambda n: (datetime.date(2000, 1, 1) + datetime.timedelta(n)).isoformat()
    terms = [(rng.choice("aab"), i, day(lo := rng.randint(0, 900)), day(lo + rng.choice([-1, 0, 1, 5, 64, 700]))) for i in range(120)] + [("a", 900, None, day(10)), ("b", 901, day(800), None), ("a", 902, None, None)]
    points = [(rng.choice("abc"), i, day(rng.randint(-50, 1000))) for i in range(200)] + [("a", 999, None)]
    got = intervals.containing(spark.createDataFrame(points, "k string, p int, d string"), spark.createDataFrame(terms, "k string, t int, lo string, hi string"), ["k"], "d", "lo", "hi")
    want = sorted((p, t) for k, p, d in points for j, t, lo, hi in terms if k == j and d and (lo is None or lo <= d) and (hi is None or d <= hi))
    assert sorted((r["p"], r["t"]) for r in got.collect()) == want
    assert intervals.containing(spark.createDataFrame(points, "k string, p int, d string"), spark.createDataFrame([], "k string, t int, lo string, hi string"), ["k"], "d", "lo", "hi").count() == 0


def test_pages(spark, tmp_path):
    rows = [(i % 7, i) for i in range(1000)] + [(None, 2000)]
    laid = pages.lay_out(spark.createDataFrame(rows, "a int, b int").repartition(5), ["a", "b"], f"{tmp_path}/t", rows_in_range=130)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for number in (1, 2, 7, 20, 21, 22):
        assert [tuple(r) for r in laid.page(number, 50).collect()] == want[(number - 1) * 50 : number * 50]
    assert laid.count(50) == 21 and len(laid.ranges(3, 50)) <= 2
    assert "PartitionFilters: [_sl_range" in laid.page(9, 50)._jdf.queryExecution().toString() or "_sl_range" in laid.page(9, 50)._jdf.queryExecution().executedPlan().toString()
    none = pages.lay_out(spark.createDataFrame([], "a int, b int"), ["a", "b"], f"{tmp_path}/n")
    assert none.page(1).count() == 0 and none.count() == 1


def test_search(spark):
    rng = random.Random(2)
    texts = [(i, "".join(rng.choice("abé 😀-") for _ in range(rng.randint(0, 60)))) for i in range(150)] + [(900, None), (901, ""), (902, "ab" * 20_000 + "zzz")]
    docs = spark.createDataFrame(texts, "id long, t string")
    asked = ["a", "b😀", "é", "ab", "aba", "abab", "b é", "zzz", "zz", "bz", "qqq", "-", "", "baabéa"]
    got = search.find(spark.createDataFrame([(q,) for q in asked], "query string"), docs, search.grams(docs, "id", "t"), "id", "t")
    assert sorted((r["query"], r["id"]) for r in got.collect()) == sorted((q, i) for q in asked if q for i, t in texts if t and q in t)


def test_array_file(spark, tmp_path):
    path = f"{tmp_path}/x.json"
    rows = [(i, f'é "{{[,\n  {{ {i}') for i in range(500)]
    df = spark.createDataFrame(rows, "i long, s string").repartition(7)
    arrayfile.export(df, F.to_json(F.struct("i", "s")), [F.col("i")], path)
    assert json.load(open(path)) == [{"i": i, "s": s} for i, s in rows]
    for size in (7, 100, 4096, 1 << 30):
        got = arrayfile.read(spark, path, "i long, s string", size).orderBy("place").collect()
        assert [(r["i"], r["s"]) for r in got] == rows
    # As people print arrays, with inner objects, and on one line.
    inner = [{"i": i, "s": "x", "o": {"k": [{"i": 1}, {}]}} for i in range(40)]
    for text in (json.dumps(inner, indent=2), json.dumps(inner), json.dumps(inner, indent=None, separators=(",", ":"))):
        open(path, "w").write(text)
        assert [r["i"] for r in arrayfile.read(spark, path, "i long, s string", 64).orderBy("place").collect()] == list(range(40))
    # A failed task leaves the old file, and no parts beside it.
    before = open(path).read()
    with pytest.raises(Exception):
        arrayfile.export(df, F.when(F.col("i") == 400, F.raise_error(F.lit("broken"))).otherwise(F.to_json(F.struct("i"))), [F.col("i")], path)
    assert open(path).read() == before and [p.name for p in tmp_path.iterdir()] == ["x.json"]
    arrayfile.export(df.where("i < 0"), F.to_json(F.struct("i")), [F.col("i")], path)
    assert json.load(open(path)) == [] and arrayfile.read(spark, path, "i long").count() == 0


def test_merge_rewrites_what_it_touches(spark, tmp_path):
    rows = [(i, "old", float(i)) for i in range(1000)]
    table = versioned.Table(spark, f"{tmp_path}/t").create(spark.createDataFrame(rows, "k long, s string, x double"), "k", rows_in_file=100)
    before = table.manifest
    edits = spark.createDataFrame([(5, "new", False), (7, None, False), (8, "gone", True), (2000, "added", False), (-3, "added", False)], "k long, s string, gone boolean")
    after = table.merge(edits, "m1", delete="gone")
    kept = {f["path"] for f in before["files"]} & {f["path"] for f in after["files"]}
    assert len(before["files"]) == 10 and len(kept) == 8
    want = {i: (s, x) for i, s, x in rows if i != 8} | {5: ("new", 5.0), 7: (None, 7.0), 2000: ("added", None), -3: ("added", None)}
    assert {r["k"]: (r["s"], r["x"]) for r in table.read().collect()} == want
    assert table.merge(edits, "m1", delete="gone") == after and table.manifest == after
    assert table.merge(edits.limit(0), "m2")["files"] == after["files"]
    with pytest.raises(versioned.Conflict):
        table._swap(before, before)
    empty = versioned.Table(spark, f"{tmp_path}/e").create(spark.createDataFrame([], "k long, s string"), "k")
    empty.merge(spark.createDataFrame([(1, "a")], "k long, s string"), "m")
    assert [tuple(r) for r in empty.read().collect()] == [(1, "a")]


def test_put_and_get(spark, tmp_path):
    put(spark, f"{tmp_path}/f", b"one")
    put(spark, f"{tmp_path}/f", b"two")
    assert get(spark, f"{tmp_path}/f") == b"two" and get(spark, f"{tmp_path}/none") is None
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["f"]


def test_xml_files(spark, tmp_path):
    docs = "<all><r><i>1</i><s>a &amp; b</s></r><r><i>x</i><s>c</s></r><r><i>3</i></r></all>"
    (tmp_path / "a.xml").write_text(docs)
    good, broken = xmltable.files(spark, str(tmp_path), "r", spark.createDataFrame([], "i int, s string").schema)
    assert sorted((r["i"], r["s"]) for r in good.collect()) == [(1, "a & b"), (3, None)] and broken.count() == 1


def test_fold_needs_no_python(spark):
    import unicodedata

    samples = ["Vélez", "ﬁn ½ №", "ÀÉÎõü ß Æ", "éa", "Ǆ ǅ", "日本 ㍿", "plain", "", None, "x’y-z"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string").select("i", T.fold(F.col("s"), False).alias("f"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    want = ["".join(c for c in unicodedata.normalize("NFKD", s or "") if not unicodedata.combining(c)).lower() for s in samples]
    assert [r["f"] for r in df.orderBy("i").collect()] == want
