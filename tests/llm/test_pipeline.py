"""The pipeline's stages on a small table with planted cases."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from seatledger.llm import neardup, queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    vocab = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(900)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(k, text(25) + ". " + text(9) + ".") for k in range(8)]
    rows = [(k, text(rng.randint(60, 200)), "en", f"s{k % 4}", 0) for k in range(60)]
    rows += [(100 + k, rows[k][1], "en", "s1", 0) for k in range(5)]
    rows += [(110 + k, rows[k][1] + " more", "en", "s1", 0) for k in range(5, 9)]
    rows += [(120 + k, text(70) + " " + items[k][1] + " " + text(30), "en", "s2", 0) for k in range(8)]
    rows += [(130, "too short", "en", "s0", 0), (131, "again " * 100, "en", "s0", 0), (132, None, "en", None, 0)]
    out = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder).persist()
        seen.append({r["doc_id"] for r in docs.select("doc_id").collect()})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    good, unique, clean, mixed, written = seen
    assert not good & {130, 131, 132} and set(range(60)) <= good
    assert unique == good - {100, 101, 102, 103, 104, 115, 116, 117, 118}
    assert clean == unique - set(range(120, 128))
    assert mixed <= clean and written == mixed and len(mixed) > 20


def test_run_agrees_with_itself(spark, folder):
    a, b = (sorted((r["slot"], r["doc_id"], r["part"], r["crc32"]) for r in corpus_pipeline.run(spark, folder).collect()) for _ in range(2))
    assert [x[0] for x in a] == list(range(len(a))) and sorted(x[1:] for x in a) == sorted(x[1:] for x in b)


def test_registry():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 11)} == {q.split("_")[0] for q in queries.QUERIES} and "pipeline" in names


def test_dedup_keeps_one_row_of_each_group(spark):
    rng = random.Random(3)
    text = lambda: " ".join(rng.choice("abcdefghij") + str(rng.randrange(50)) for _ in range(60))
    a, b, c, d, e, f = (text() for _ in range(6))
    rows = [
        (1, a, "x"), (1, a, "y"), (2, a + " more", "x"),  # one id twice, and a near copy: one row of id 1 stays
        (3, b, "x"), (7, b + " more", "x"), (7, c, "x"),  # two texts under id 7: only the near copy goes
        (None, d, "x"), (None, d, "y"), (None, d + " more", "x"),  # copies without an id: one stays
        (None, e, "x"), (9, e, "x"),  # an id comes before none
        (None, f, "x"), (None, None, "x"), (None, None, "x"), (10, "", "x"), (10, "", "x"),  # nothing to compare
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string").repartition(3)
    got = neardup.dedup(docs)
    assert got.columns == docs.columns
    kept = got.collect()
    assert sorted(r["doc_id"] for r in kept if r["text"] and r["doc_id"]) == [1, 3, 7, 9]
    texts = [r["text"] for r in kept]
    assert [texts.count(x) for x in (a, b, c, e, f, None, "")] == [1, 1, 1, 1, 1, 2, 2]
    assert a + " more" not in texts and b + " more" not in texts and texts.count(d) + texts.count(d + " more") == 1
    assert len(kept) == 10
