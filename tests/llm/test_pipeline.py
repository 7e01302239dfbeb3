import os

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tablesync.llm import registry

SF_DIR = contract.SMOKE_DIR
given = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")
TABLES = {"op1": ("pages", "page_id"), "op11": ("embeddings", "vec_id"), "op13": ("conversations", "conv_id")}


def test_all_operators_are_registered():
    names = [q.__name__.split("_")[0] for q in registry.QUERIES]
    assert names == [f"op{n}" for n in range(1, 14)]
    assert set(contract.queries()) >= {q.__name__ for q in registry.QUERIES} | {"pipeline"}


@given
@pytest.mark.parametrize("query", registry.QUERIES, ids=lambda q: q.__name__)
def test_queries_answer_for_every_row(spark, query):
    table, key = TABLES.get(query.__name__.split("_")[0], ("documents", "doc_id"))
    want = {r[key] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).collect()}
    want |= {-7} if table == "conversations" else set()
    assert {r[key] for r in query(spark, SF_DIR).select(key).collect()} == want


@given
def test_stages_work_on_what_is_left(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR).cache()
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert now <= seen and now, name
        if name != "packing":
            assert docs.columns == columns, name
        if name in ("quality", "near_duplicates"):
            assert now < seen, name
        seen = now
    assert "sequence_id" in docs.columns


def test_packed_pieces_carry_their_tokens(spark):
    docs = spark.createDataFrame([(1, "some words to pack"), (2, "more of them")], "doc_id long, text string")
    rows = corpus_pipeline.packing(spark, docs, SF_DIR).collect()
    assert rows and all(len(r["ids"]) == 4 * r["length"] > 0 for r in rows)


def odd_table(spark, folder, rows):
    """Documents with nulls, repeats and columns whose names the stages use inside, and labels for some."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, node long, root long, row string, part int, size long"
    filled = [(i, t, "en", s, None if t is None else len(t), 1, 2, "r", 3, None) for i, t, s in rows]
    spark.createDataFrame(filled, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(len(t.split()) > 60), 0) for i, t, _ in rows if i is not None and t][:40]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_run_on_odd_rows(spark, corpus, tmp_path, monkeypatch):
    odd_table(spark, tmp_path, corpus)
    monkeypatch.setattr("tablesync.files.checkpoint_root", lambda spark: str(tmp_path / "shared"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert rows and {r["doc_id"] for r in rows} <= {i for i, _, _ in corpus}
    for r in rows:
        assert 0 < r["length"] <= 4096 and len(r["ids"]) == 4 * r["length"]
    # One table of the last stage is left in the shared folder, nothing else.
    assert [n.split("-")[1] for n in os.listdir(tmp_path / "shared")] == ["packing"]


def test_stages_keep_clashing_columns(spark, corpus, tmp_path):
    odd_table(spark, tmp_path, corpus)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns, name
        docs = after
    found = docs.select("node", "root", "row", "part", "size").distinct().collect()
    assert [tuple(r) for r in found] == [(1, 2, "r", 3, None)]


def test_run_on_an_empty_table(spark, tmp_path):
    odd_table(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
