"""Helpers that the operators of this package share."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import tidemark
from tidemark.sources.workdir import shared_dir

#: Rows of a small join side up to which it may be broadcast; beyond it the join is salted.
BROADCAST_ROWS = 2_000_000
#: Parts into which a salted join deals the rows of one key.
SALTS = 32
#: Documents that Python code holds as objects at one time.
SLICE = 256


def fold(doc_id: str, parts: int) -> Column:
    """``crc32(doc_id as text) mod parts``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read back.

    Later steps read the files, so a lost executor costs no more than its own tasks.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of each step run in this block when the step ends.

    For steps whose rows are ``stored``: later ones read these and not the shuffles.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_join(
    large: DataFrame,
    small: DataFrame,
    keys: list[str],
    rows: int,
    spread: Column,
    how: str = "inner",
) -> DataFrame:
    """Join (inner or left) of ``large`` with a side of ``rows`` counted rows.

    Up to ``BROADCAST_ROWS`` rows the small side is broadcast.  Beyond, it is repeated
    once per salt and the large side is dealt over the salts by ``spread``, so that one
    hot key meets in ``SALTS`` tasks and not in one.
    """
    if rows <= BROADCAST_ROWS:
        return large.join(F.broadcast(small), keys, how)
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = large.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, [*keys, "_salt"], how).drop("_salt")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for code run in Python."""
    context = spark.sparkContext
    if not getattr(context, "_tidemark_sent", False):
        package = Path(tidemark.__file__).parent
        name = f"{tempfile.mkdtemp()}/tidemark-{uuid.uuid4().hex[:8]}"
        context.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))
        context._tidemark_sent = True


def arrow_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def map_documents(
    df: DataFrame,
    make: Callable[[], Callable[[pa.Array], Iterable]],
    fields: str,
    slice_rows: int = SLICE,
    spread: bool = False,
) -> DataFrame:
    """One row per row of ``df``, whose last column goes through Python.

    ``make()`` runs once per task and gives a function from an Arrow array of values to one
    list or Arrow array per field of ``fields`` (a DDL string).  The other columns pass unchanged.
    With ``spread`` a row may give any number of rows: the function's first result is the
    number, within the array, of the value that each of them is of.
    """
    ship(df.sparkSession)
    value = df.columns[-1]
    kept = df.columns[:-1]
    new = StructType.fromDDL(fields)
    schema = StructType([*(df.schema[c] for c in kept), *new])
    types = [f.type for f in arrow_schema(new)]
    names = [*kept, *new.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                found = work(part.column(len(kept)))
                columns = part.columns[: len(kept)]
                if spread:
                    of, *found = found
                    columns = [c.take(pa.array(of, pa.int64())) for c in columns]
                arrays = [
                    x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(found, types)
                ]
                yield pa.RecordBatch.from_arrays([*columns, *arrays], names)

    return df.select(*kept, value).mapInArrow(run, schema)


def map_texts(
    df: DataFrame, make: Callable[[], Callable[[str | None], tuple]], fields: str
) -> DataFrame:
    """Like ``map_documents``, with a function from one text to one value per field."""
    width = len(StructType.fromDDL(fields))

    def make_slices():
        work = make()
        return lambda texts: list(zip(*map(work, texts.to_pylist()))) or [[]] * width

    return map_documents(df, make_slices, fields)


def span_digest(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` of an array of span structs, comma-joined in their order."""
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def row_key(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key`` and ``text``.

    The two keys tell rows apart that share an id but not a text; equal rows share both,
    and so do their results.
    """
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def same_row(left: str, right: str) -> Column:
    """Join condition on the keys of ``row_key``; a NULL id meets a NULL id."""
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (
        F.col(f"{left}.text_key") == F.col(f"{right}.text_key")
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int) -> DataFrame:
    """``doc_id``, ``label`` and ``text`` of at most ``rows`` labelled documents.

    The ids with the least hashes are taken among those for which ``usable`` holds, so the
    sample is the same whatever the partitions.  Of a repeated id the text of the least hash
    is taken.
    """
    ids = (
        labels.filter(usable & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    return (
        docs.select("doc_id", "text")
        .join(F.broadcast(ids), "doc_id")  # ``rows`` rows at most
        .groupBy("doc_id")
        .agg(F.first("label").cast("int").alias("label"), F.min_by("text", F.xxhash64("text")).alias("text"))
    )


def labelled(docs: DataFrame, labels: DataFrame, label: str, usable: Column) -> DataFrame:
    """``doc_id``, ``label`` and ``text`` of every document with a label for which ``usable`` holds.

    Of a repeated id the text of the least hash is taken.
    """
    ids = (
        labels.filter(usable & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    )
    found = small_join(docs.select("doc_id", "text"), ids, ["doc_id"], ids.count(), F.col("text"))
    return found.groupBy("doc_id").agg(
        F.first("label").alias("label"), F.min_by("text", F.xxhash64("text")).alias("text")
    )


def map_groups(
    df: DataFrame, keys: list[str], work: Callable[[pa.RecordBatch], Iterable], fields: str
) -> DataFrame:
    """``work`` on the rows of each group, which must be bounded; ``fields`` is its result.

    Rows are dealt and sorted by ``keys`` (numbers without NULL), and each task passes over
    its groups one by one: cheaper than a call of ``applyInPandas`` for very many groups.
    """
    ship(df.sparkSession)
    schema = StructType.fromDDL(fields)
    types, names = [f.type for f in arrow_schema(schema)], schema.names

    def result(found):
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(found, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the group that may go on in the next batch

        def ended():
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            return result(work(whole))

        for batch in batches:
            if not batch.num_rows:
                continue
            if held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
                yield ended()
                held = []
            values = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            new = np.logical_or.reduce([v[1:] != v[:-1] for v in values])
            edges = [0, *(np.flatnonzero(new) + 1), batch.num_rows]
            for start, end in zip(edges, edges[1:]):
                held.append(batch.slice(start, end - start))
                if end < batch.num_rows:
                    yield ended()
                    held = []
        if held:
            yield ended()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def positions(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with their ``position`` in their ``tree`` by ``order``, and its ``size``.

    Rows are sorted over all tasks; a count per task and tree gives where each task begins,
    so no tree is sorted by one task.
    """
    dealt = rows.withColumn("_deal", F.rand(7))  # equal rows need not meet in one task
    dealt = stored(
        dealt.repartitionByRange("tree", *order, "_deal")
        .sortWithinPartitions("tree", *order)
        .drop("_deal")
        .withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}),
        name,
    )
    parts = dealt.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "tree",
        "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(tree).alias("size"),
    )
    return (
        dealt.join(parts, ["tree", "_part"])
        .withColumn("position", F.col("_at") + F.col("_shift"))
        .drop("_part", "_at", "_shift")
    )


def components(edges: DataFrame, name: str) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for edges ``(u, v)``.

    Labels go to the neighbours and along themselves until none changes: few rounds, each
    one written to the shared folder; the driver sees one count per round.
    """
    both = stored(
        edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(),
        f"{name}-edges",
    )
    labels = stored(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("root")), f"{name}-labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("root").alias("near"))
        )
        hooked = labels.join(near, "u").select("u", "root", F.least("root", "near").alias("new"))
        jump = labels.select(F.col("u").alias("new"), F.col("root").alias("far"))
        moved = stored(
            hooked.join(jump, "new", "left").select("u", "root", F.least("new", "far").alias("new")),
            f"{name}-labels",
        )
        changed = moved.filter("root <> new").limit(1).count()
        labels = moved.select("u", F.col("new").alias("root"))
        if not changed:
            return labels.withColumnRenamed("u", "node")
