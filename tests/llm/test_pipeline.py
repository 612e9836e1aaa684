"""The corpus pipeline: each stage against plain Python with clashing column names, and a run over planted cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline

CLASHING = ("score", "gone", "kept", "n_bytes", "n_removed", "contaminated", "n_hit", "component_key", "text_key", "spans", "ids")


def _prose(r, n):
    return " ".join("".join(r.choice("aeioulmnrst") for _ in range(r.randint(3, 8))) for _ in range(n))


def _docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    return df.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in CLASHING})


def _carried(df):
    """(doc_id, text, n_chars) of the rows, whose other columns must be as they were."""
    got = df.collect()
    for x in got:
        assert all(x[c] == c + ("-" if x["doc_id"] is None else str(x["doc_id"])) for c in CLASHING)
    return sorted(((x["doc_id"], x["text"], x["n_chars"]) for x in got), key=str)


def _want(rows):
    return sorted(((i, t, None if t is None else len(t)) for i, t in rows), key=str)


def test_toxic_documents_go(spark, monkeypatch):
    rows = [(1, "calm words"), (2, "bad"), (None, None), (3, ""), (4, "calm words"), (4, "calm words")]
    monkeypatch.setattr(pipeline, "toxicity_network", lambda spark, d: None)
    docs = _docs(spark, rows)
    out = pipeline.drop_toxic(spark, docs, None)
    assert out.columns == docs.columns and _carried(out) == _want(rows)
    marked = lambda rows, net, carry: rows.select(*carry, F.when(F.col("text") == "bad", 1.0).otherwise(0.0).alias("score"))
    monkeypatch.setattr(pipeline.toxicity, "score", marked)
    assert _carried(pipeline.drop_toxic(spark, docs, None)) == _want([x for x in rows if x[1] != "bad"])


def test_one_of_each_group_stays(spark):
    r = random.Random(3)
    a, b = _prose(r, 60), _prose(r, 60)
    rows = [(5, a), (1, a + " end"), (3, b), (3, b), (4, None), (None, a), (None, a), (6, " "), (7, "one two")]
    docs = _docs(spark, rows)
    out = pipeline.drop_near_copies(spark, docs, None)
    assert out.columns == docs.columns
    assert _carried(out) == _want([x for x in rows if x[0] not in (5, 3)] + [(3, b)])
    assert pipeline.drop_near_copies(spark, docs.where("false"), None).collect() == []


def test_repeated_passages_are_cut(spark):
    r = random.Random(5)
    shared = _prose(r, 15)
    rows = [(1, "é" + shared + _prose(r, 10)), (2, _prose(r, 9) + shared + "ü"), (3, None), (4, ""), (5, "short"), (None, shared)]
    docs = _docs(spark, rows)
    out = pipeline.cut_repeats(spark, docs, None)
    assert out.columns == docs.columns
    first = (dict(rows[:1])[1]).encode()

    def plain(t):
        b, gone = t.encode(), set()
        for i in range(len(b) - 49):
            if b[i:i + 50] in first:
                gone.update(range(i, i + 50))
        return bytes(c for i, c in enumerate(b) if i not in gone).decode("utf-8", "ignore")

    left = plain(rows[1][1])
    assert len(left) < len(rows[1][1]) - 50
    assert _carried(out) == _want([rows[0], (2, left), *rows[2:]])


def test_benchmark_documents_go(spark, tmp_path):
    r = random.Random(6)
    item = _prose(r, 20)
    spark.createDataFrame([("q1", item)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(1, _prose(r, 30) + " " + item), (2, _prose(r, 500) + " " + " ".join(item.split()[:12])), (3, None), (None, item.upper()), (4, "")]
    docs = _docs(spark, rows)
    out = pipeline.drop_benchmark(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and _carried(out) == _want([rows[1], rows[2], rows[4]])


def test_run_over_planted_cases(spark, tmp_path):
    r = random.Random(8)
    bad = ("vqxar", "vqxon", "vqxim")
    rows, toxic = [], set()
    for i in range(200):
        w = _prose(r, r.randint(40, 90)).split()
        if i % 4 == 1:
            toxic.add(i)
            for _ in range(4):
                w.insert(r.randrange(len(w)), r.choice(bad))
        rows.append((i, " ".join(w)))
    item, passage = _prose(r, 20), _prose(r, 60)
    planted = [(300, rows[0][1] + " tail"), (301, rows[2][1]), (302, _prose(r, 50) + " " + passage), (303, passage + " " + _prose(r, 50)),
               (304, _prose(r, 15) + " " + item), (305, ""), (306, None)]
    docs = spark.createDataFrame(rows + planted, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i in toxic)) for i in range(200)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([("q1", item)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {x["doc_id"]: x for x in pipeline.run(spark, str(tmp_path)).collect()}
    assert not toxic & got.keys() and not {300, 301, 304} & got.keys()
    assert got.keys() == {i for i in range(200) if i not in toxic} | {302, 303, 305, 306}
    for i, t in rows:
        if i in got:
            assert got[i]["text"] == t
    assert passage in got[302]["text"] and passage[:50] not in got[303]["text"] and got[303]["n_chars"] == len(got[303]["text"])
    assert got[305]["text"] == "" and got[306]["text"] is None
    for x in got.values():
        assert x["decoded"] == (x["text"] or "") and bool(re.search(r"\w", x["text"] or "")) == (len(x["ids"]) > 0)


@pytest.mark.parametrize("stage", ["drop_near_copies", "cut_repeats"])
def test_stages_take_empty_tables(spark, stage):
    docs = _docs(spark, [(1, "x")]).where("false")
    out = getattr(pipeline, stage)(spark, docs, None)
    assert out.columns == docs.columns and out.collect() == []
