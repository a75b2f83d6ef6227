"""The pipeline against brute force, stage by stage, and its contract."""

import inspect

from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.conftest import SF_SMALL
from tests.llm.test_native import plain_report, plain_secrets
from tests.llm.test_near_duplicates import plain
from tidemark.llm import language, secrets
from tidemark.llm.common import fold


def test_stages():
    assert [n for n, _ in cp.STAGES] == ["language", "ngram_join", "decontaminate", "secrets", "byte_bpe"]
    assert all(list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"] for _, f in cp.STAGES)


def test_run(spark, documents, texts):
    model = language.learn(documents, fold("doc_id", 4) != 2)
    found = language.predict(documents, model).filter("lang_pred <> 'und' AND NOT ambiguous")
    rows = sorted((r.doc_id, texts[r.doc_id]) for r in found.collect())
    rows = [row for row, (least, _, _) in zip(rows, plain(rows).values()) if row[0] == least]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in rows if not plain_report(t, items)[-1]]
    spans = {r.doc_id: len(r.spans) for r in secrets.find(documents).collect()}
    rows = [(i, t) for i, t in rows if not plain_secrets(t) and not spans[i]]
    got = cp.run(spark, SF_SMALL)
    assert sorted(r.doc_id for r in got.collect()) == [i for i, _ in rows]
    assert len(rows) < len(texts)
    whole = documents.select("doc_id", F.sha2("text", 256).alias("sha"))
    assert got.join(whole, "doc_id").filter("sha <> decoded_sha256").count() == 0


def test_stages_keep_columns_and_take_odd_tables(spark, odd):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for rows in (docs, docs.limit(0), odd):
        for name, stage in cp.STAGES[:-1]:
            out = stage(spark, rows, SF_SMALL)
            assert out.columns == docs.columns or out.columns == odd.columns, name
            out.collect()
        assert cp.STAGES[-1][1](spark, rows, SF_SMALL).count() == rows.count()
