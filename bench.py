"""Time the headline queries and one whole Bronze -> Silver -> Gold run.

Prints one JSON line.  ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose tables and cores,
``BENCH_QUERIES`` (comma separated) a subset.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.plans.medallion import Medallion  # noqa: E402
from tidemark.sources.workdir import shared_dir  # noqa: E402
from tidemark.spec import DOMAINS  # noqa: E402
from workloads.inputs import landing  # noqa: E402
from workloads.registry import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    """Compute every row and column without sending them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    began = time.perf_counter()
    work()
    return round(time.perf_counter() - began, 3)


def settled(work, runs: int = 3, long: float = 10.0) -> float:
    """Median of a few runs, so that one slow moment of the machine does not count.

    What takes longer than ``long`` seconds is run twice.
    """
    first = timed(work)
    more = [timed(work) for _ in range(1 if first > long else runs - 1)]
    return round(statistics.median([first, *more]), 3)


def corpus(spark: SparkSession) -> dict[str, float]:
    """Each corpus query once; the passage search, which exceeds its budget, is left out."""
    try:
        from tidemark.llm.queries import QUERIES as found
    except ImportError:
        return {}
    return {
        name: timed(lambda: drain(found[name](spark, SF_DIR))) for name in found if name != "op8_passages"
    }


def medallion(spark: SparkSession) -> dict[str, float]:
    """All 26 models from landing tables, then all checks."""
    root = shared_dir(spark, "bench")
    feeds = {}
    for name in DOMAINS:
        place = f"{root}/landing/{name}"
        # several landing files per domain, as parallel sink tasks would leave them
        landing(spark, SF_DIR, name).repartition(int(CPUS)).write.parquet(place)
        feeds[name] = spark.read.parquet(place)
    written = Medallion(spark, f"{root}/written", materialise_silver=True)
    lean = Medallion(spark, f"{root}/lean")
    return {
        "medallion_run_26_models": timed(lambda: written.run(feeds, feeds)),
        "medallion_checks_185": timed(lambda: drain(written.check())),
        "medallion_run_silver_views": timed(lambda: lean.run(feeds, feeds)),
    }


def main() -> None:
    spark = session()
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else list(QUERIES)
    drain(QUERIES["scan_changes"](spark, SF_DIR))  # start the JVM's code paths once
    seconds = {name: settled(lambda: drain(QUERIES[name](spark, SF_DIR))) for name in names}
    if not wanted:
        seconds.update(medallion(spark))
    print(
        json.dumps(
            {
                "metric": "total wall time of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "corpus": {} if wanted else corpus(spark),
            }
        )
    )


if __name__ == "__main__":
    main()
