"""Registered queries against their SQL, and the pipeline's stages on planted documents."""

import random

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import queries
from check import TABLES, compare
from gaugeframe.llm.queries import ORACLES, QUERIES
from gaugeframe.sources.scratch import scratch_path

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    result, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert result.startswith("ok"), result


def test_all_names_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]


def test_stages_take_effect(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abdeginorst") for _ in range(5))
    text = lambda n: " ".join(word() for _ in range(n))
    rows, labels = [], []
    for i in range(600):
        bad = i % 6 == 0
        rows.append((i, text(60) + (" you idiot scum moron" if bad else ""), "en", f"s{i % 3}", 0, "x"))
        labels.append((i, int(bad)))
    leak = text(30)
    copy = text(80)
    rows += [(700, text(20) + " " + leak, "en", "s0", 0, "x"), (701, copy, "en", "s0", 0, "x"),
             (702, copy + " more", "en", "s1", 0, "x"), (701, copy, "en", "s0", 0, "x"),
             (703, "write to a.b@x.org now " + text(30), "en", "s1", 0, "x"),
             (704, None, None, None, None, None), (None, copy, "en", "s2", 0, "x"),
             (None, text(40), "en", "s2", 0, "x"), (705, "", "en", "s2", 0, "x")]
    root = scratch_path(spark, "tables")
    spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, kept string"
    ).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(
        f"{root}/benchmark.parquet")

    docs, kept = spark.read.parquet(f"{root}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        path = scratch_path(spark, "stage")
        stage(spark, docs, root).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = docs.collect()
        assert name == "mixing" or docs.columns == columns
    ids = {name: sorted(r["doc_id"] for r in found if r["doc_id"] is not None)
           for name, found in kept.items()}
    clean = [i for i in range(600) if i % 6]
    assert ids["toxicity"] == clean + [700, 701, 701, 702, 703, 704, 705]
    assert ids["near_copies"] == clean + [700, 701, 703, 704, 705]
    assert [r["text"] == copy for r in kept["near_copies"] if r["doc_id"] is None] == [False]
    assert ids["decontamination"] == clean + [701, 703, 704, 705]
    text_of = {r["doc_id"]: r for r in kept["personal_data"]}
    assert text_of[703]["text"].startswith("write to [EMAIL] now")
    assert text_of[703]["n_chars"] == len(text_of[703]["text"]) and text_of[704]["text"] is None
    assert ids["mixing"] == ids["personal_data"]
    assert all(r["taken"] <= 3 * r["size"] for r in kept["mixing"])
