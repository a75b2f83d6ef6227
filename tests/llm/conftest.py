import pytest

SF_SMALL = "/root/testdata/sf0.001"

ODD_TEXTS = [
    None,
    "",
    "   \n\t ",
    "...!!! ###",
    "one",
    "word " * 30_000,
    "x" * 60_000,
    "MiXeD  ünïcödé    日本語 🎉🎉 \x1c\x1f 12345 it's  we'll\r\n\n  tail  ",
    "a" * 500 + "ab" * 400 + " " * 300 + "🎉" * 90,
]
CLASHING = {
    "n_words": "x", "kept": "y", "ids": "z", "spans": 1, "lang_key": 2, "score": 3, "_salt": 4,
    "key": 5, "h": 6, "pos": 7, "copy_id": 8, "tree": 9, "held_out": 10, "class_id": 11, "n": 12,
}


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts, two repeated rows, NULLs in every column, and clashing further columns."""
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "src") for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[4], rows[4], (None, "a null id has text too", None, None)]
    schema = "doc_id long, text string, lang string, source string"
    docs = spark.createDataFrame(rows, schema)
    from pyspark.sql import functions as F

    return docs.withColumn("n_chars", F.length("text")).withColumns(
        {k: F.lit(v) for k, v in CLASHING.items()}
    )


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}
