"""Ranks over all tasks, export batches, and run documents that cannot be read."""

import json
import random

import pytest
from support import plan
from tidemark.operators.ranking import global_rank
from tidemark.sources.artifacts import broken_run_results, read_run_results, run_documents
from tidemark.sources.exports import select_files


@pytest.mark.parametrize("tasks", [1, 7])
def test_ranks_are_those_of_one_sort(spark, tasks):
    names = [f"n{random.Random(5).random()}", *(f"n{i * 37 % 401:04d}" for i in range(401))]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, i int")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked, total = global_rank(df, "name")
        got = {r["name"]: r["rank"] for r in ranked.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert total == 402 and got == {n: i + 1 for i, n in enumerate(sorted(names))}
    none, total = global_rank(df.limit(0), "name")
    assert total == 0 and none.count() == 0


def test_batches_are_not_sorted_in_one_task(spark, tmp_path):
    for i in range(50):
        (tmp_path / f"kafka_orders_{i:02d}.json").write_text("{}")
    first = select_files(spark, str(tmp_path), "initial")
    rest = select_files(spark, str(tmp_path), "incremental")
    names = [f"kafka_orders_{i:02d}.json" for i in range(50)]
    assert sorted(r["file"] for r in first.collect()) == names[:40]
    assert sorted(r["file"] for r in rest.collect()) == names[40:]
    text = first._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "SinglePartition" not in text


def test_run_documents(spark, tmp_path):
    def document(run, results):
        return json.dumps({"metadata": {"invocation_id": run}, "results": results}, indent=1)

    good = {"unique_id": "model.p.silver_x", "status": "success", "execution_time": 1, "timing": []}
    texts = {
        "a": document("i1", [good, {"unique_id": "model.p.gold_y", "status": "fail", "other": {"x": 1}}]),
        "b": document("i2", []),
        "cut": document("i3", [good])[:-4],
        "typed": document("i4", [{"unique_id": "m", "execution_time": "soon"}]),
        "none": " ",
    }
    for name, text in texts.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "run_results.json").write_text(text)
    rows = read_run_results(spark, str(tmp_path)).collect()
    assert sorted((r["invocation_id"], r["unique_id"], r["execution_time"]) for r in rows if r["execution_time"]) == [
        ("i1", "model.p.silver_x", 1.0)]
    assert len(rows) == 2
    broken = {r["file"].split("/")[-2] for r in broken_run_results(spark, str(tmp_path)).collect()}
    assert broken == {"cut", "typed", "none"}


def test_a_run_document_is_parsed_once(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"metadata": {"invocation_id": "i"}, "results": []}')
    for rows in (read_run_results(spark, str(tmp_path)), broken_run_results(spark, str(tmp_path))):
        assert plan(rows).lower().count("parsejson") == 1


def test_results_and_broken_files_are_read_from_stored_documents(spark, tmp_path):
    made, kept = tmp_path / "made", str(tmp_path / "kept")
    made.mkdir()
    (made / "good.json").write_text(
        '{"metadata": {"invocation_id": "i"}, "results": [{"unique_id": "m", "execution_time": 2.5}]}')
    (made / "cut.json").write_text('{"metadata": {"invocation_id": "j"}, "results": [')
    run_documents(spark, str(made)).write.parquet(kept)
    documents = spark.read.parquet(kept)
    for given in (None, documents):
        rows = read_run_results(spark, str(made), given).select("invocation_id", "unique_id", "execution_time")
        assert [tuple(r) for r in rows.collect()] == [("i", "m", 2.5)]
        assert [r["file"].split("/")[-1] for r in broken_run_results(spark, str(made), given).collect()] == ["cut.json"]
    assert "Scan text" not in plan(read_run_results(spark, str(made), documents))
