"""Queries against their SQL on small tables of odd rows."""

from __future__ import annotations

from collections import Counter

from seatledger.plans import queries, table_queries  # noqa: F401  both register


def _equal(spark, folder, name, **tables):
    """The query gives the rows of its SQL over ``tables`` (DataFrames); returns how many."""
    import duckdb

    con = duckdb.connect()
    for t, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{t}.parquet")
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
    got = queries.QUERIES[name](spark, str(folder))
    res = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    want = Counter(res.fetchall())
    assert Counter(tuple(r[c] for c in names) for r in got.collect()) == want
    return sum(want.values())


def test_html_pre_text_odd_pages(spark, tmp_path):
    """References that are cut off, that the SQL leaves, or that come together when tags go; pre elements of the page's own; null."""
    pages = [
        "<title>a = &quot</title><script>var t</script>", "&copy 1 &copy; &middot; &lt;b&gt; &nbsp; &#39; &#x41; &amp;copy; &ampx &amp", "&co<b>py;</b> &quo<i>t; &am</i>p;",
        "<p>a</p><pre>b</pre><article>c <pre>d</pre> e</article> f", "<PRE x>a</PRE> b < pre <pre c", "</article>x<article>y", "<article></article>z", "<article>a\n<b\n>c</b></article>d<article>e</article>", "<a <pre>b</pre >c</pre>", "", None,
    ]
    assert _equal(spark, tmp_path, "html_pre_text", pages=spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")) == len(pages) - 1


def test_signer_reads_each_line_once(spark):
    """The plan names the closing sentence once; where it breaks between lines, in exotic spaces, or stands in a note, as before."""
    from pyspark.sql import functions as F

    from seatledger.operators import letters

    cases = [
        ("Ann Oak,\nMember of Congress.\nX. Without  \n\x1f objection, so", "Ann Oak"), ("A\nBob  Elm.\nU. S. Representative, x\nThe RESIGNATION is\n\n accepted", "Bob Elm"), ("Cy Ash;\n  tenth-x  DISTRICT, ohio\nDone\n===  Note ===\nWithout objection", "Cy Ash"),
        ("Di Fir\n　Chair　\n____\nthe resignation is accepted\nEd Yew\nWithout objection", "Di Fir"), ("Without objection\nEd Yew", None), ("=== NOTE ===\nA", None), ("A\nunited nations\nresignation\nWITHOUT OBJECTION", "resignation"), ("x Flo Box\u0085Majority  Leader.", "Flo Box"),
    ]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    assert [r[0] for r in rows.orderBy("i").select(letters.signer(F.col("t"))).collect()] == [w for _, w in cases]
    plan = rows.select(letters.signer(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("without objection") <= 2


def test_index_of_texts_is_bounded(spark, monkeypatch):
    """A batch is indexed some texts at a time, a long text alone, and the rows are those of one piece."""
    from seatledger.operators import search

    texts = spark.createDataFrame([(1, "abcab"), (2, None), (3, ""), (4, "x" * 50), (5, "é😀é😀"), (6, "abc")], "id long, t string").coalesce(1)
    rows = lambda: sorted((r["id"], r["gram"], tuple(r["at"])) for r in search.grams(texts, "id", "t").collect())
    whole = rows()
    monkeypatch.setattr(search, "CHARACTERS", 8)
    assert rows() == whole and len(whole) > 10
    import numpy as np

    assert search._pieces(np.array([3, 0, 50, 4, 4, 1]), 8) == [(0, 2), (2, 3), (3, 5), (5, 6)] and search._pieces(np.array([], int), 8) == []
    found = search.find(spark.createDataFrame([("abc",), ("é",)], "query string"), texts, search.grams(texts, "id", "t"), "id", "t")
    assert sorted(map(tuple, found.collect())) == [("abc", 1), ("abc", 6), ("é", 5)]


def test_equal_names_and_candidates_meet_once(spark, tmp_path, monkeypatch):
    """Suppliers of one printed name are asked for once, and customers that no filter tells apart are one candidate."""
    from seatledger.operators import resolve

    met, plain = [], resolve.skip_if_empty

    def counted(df, *args):
        met.append(df.count())
        return plain(df, *args)

    monkeypatch.setattr(resolve, "skip_if_empty", counted)
    supplier = spark.createDataFrame([(i, 5 * (i % 2)) for i in range(0, 26 * 5 * 400, 13)], "s_suppkey long, s_nationkey int")
    customer = spark.createDataFrame([(i, 5 * (i % 2), 1.0 - 2 * (i % 7 == 0), "BUILDING" if i % 50 else "MACHINERY") for i in range(4000)], "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string")
    assert _equal(spark, tmp_path, "resolve_cascade", supplier=supplier, customer=customer) >= 0
    assert max(met) < 20_000, met


def test_points_of_one_level_are_not_copied(spark, tmp_path):
    """Terms from 21 days to open ones are filed on one level, under which a date looks up one cell."""
    from seatledger.operators import intervals

    orders = spark.sql("select id as o_orderkey, id % 40 as o_custkey, timestamp'1992-03-01' + make_interval(0, 0, 0, cast(id * 7 % 2500 as int)) as o_orderdate from range(3000)")
    customer = spark.sql("select id as c_custkey from range(40)")
    assert _equal(spark, tmp_path, "served_terms", orders=orders, customer=customer) > 1000
    plan = queries.QUERIES["served_terms"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 2, plan  # the five terms of a customer, and the cells of a term
    assert intervals.levels({0: (10**6, 10**6), 20: (10**6, 10**12)}, 10**6) == {0: 3, 20: 20}
    assert intervals.levels({5: (9, 180), 9: (9, 2800)}, 10**6) == {5: 8, 9: 8} and intervals.levels({}, 5) == {}


def test_compressed_array_file(spark, tmp_path, monkeypatch):
    """A compressed array is the same text to any zstd reader, places and numbers are those of it, and ranges of any size read it."""
    import json

    import pyarrow as pa
    from pyspark.sql import functions as F

    from seatledger.sources import arrayfile

    rows = [(i, f'é "{{[,\n  {{ {i},' * (i % 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "i long, s string").repartition(7)
    plain, packed = f"{tmp_path}/x.json", f"{tmp_path}/x.json.zst"
    for path in (plain, packed):
        arrayfile.export(df, F.to_json(F.struct("i", "s")), [F.col("i")], path, compressed=path == packed)
    text = open(plain, "rb").read()
    assert pa.input_stream(packed, compression="zstd").read() == text and [e["i"] for e in json.loads(text)] == list(range(3000))
    assert len(open(packed, "rb").read()) < len(text) / 4 and sorted(p.name for p in tmp_path.iterdir()) == ["x.json", "x.json.zst"]
    for size in (100, 50_000, 1 << 30):
        got = arrayfile._read(spark, packed, size).orderBy("number").collect()
        assert [r["number"] for r in got] == list(range(3000))
        assert [text[r["place"] :][: len(r["element"].encode())] for r in got] == [r["element"].encode() for r in got]
        assert [(r["i"], r["s"]) for r in arrayfile.read(spark, packed, "i long, s string", size).orderBy("place").collect()] == rows
        assert sorted((r["number"], r["i"]) for r in arrayfile.numbered(spark, packed, "i long", size).collect()) == [(i, i) for i in range(3000)]
    arrayfile.export(df.where("i < 0"), F.to_json(F.struct("i")), [F.col("i")], packed, compressed=True)
    assert pa.input_stream(packed, compression="zstd").read() == b"[]\n" and arrayfile.numbered(spark, packed, "i long").count() == 0


def test_house_text_patterns(spark):
    """The patterns that begin with one character find what the plain ones find, and those of absent words do not run."""
    import random

    from pyspark.sql import functions as F

    from seatledger.operators import blocks, members

    rng = random.Random(5)
    words = ["Attest", " attest :", "xattest:", "<all>", "<", "Committee on", "COMMITTEE  A", "subCommittee on", "Mr.", "é.mr.", "Mrs. ", "_ms.", " miss.", ", ", ";", " and ", " & ", "  and ", " and, ", "a", "9", " ", ".", "é", "😀mr.", "(", ")"]
    texts = ["".join(rng.choice(words) for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    low, honorific = F.lower("t"), F.array(*[F.lit(f"{h}.") for h in ("mr", "ms", "mrs", "miss")])
    named = F.exists(F.split(low, r"[^\p{L}\p{N}_.]+"), lambda w: F.exists(honorific, lambda h: F.startswith(w, h)))
    got = df.select(
        F.split("t", blocks.END) == F.split("t", r"(?i)\bAttest\s*:|<all>"), F.split("t", f"(?={blocks.HEADER})") == F.split("t", r"(?=\b(?:Committee|COMMITTEE)\s+[A-Za-z])"), low.rlike(members.HONORIFIC) == named,
        F.split("t", "[,; ](?:(?<! )|(?:and|&) )") == F.split("t", "[,;]| (?:and|&) "),
    )
    assert all(all(r) for r in got.collect())


def test_documents_are_parsed_once(spark):
    """The plan cuts a House text once: no test for an empty list of blocks repeats the parser."""
    from seatledger.operators import blocks

    docs = spark.createDataFrame([(1, "<pre>Resolved, That the following are elected to the following: Committee on Rules: Mr. Oak. Attest: x</pre>"), (2, ""), (3, None)], "i int, body string")
    rows = blocks.house_text(docs)
    assert [(r["i"], r["block_pos"], r["committee"]) for r in rows.collect()] == [(1, 0, "Committee on Rules")]
    plan = rows.select("i", "committee", "pairs")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("posexplode") == 1 and plan.count("all>") == 1, plan
