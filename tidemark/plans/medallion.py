"""One Bronze -> Silver -> Gold run over landing tables.

Domains do not depend on each other and are submitted together, then the reports are;
Spark shares the cluster between them.  Every table is written before the next layer
reads it, so a lost executor never costs more than the table at hand, and no lineage
grows.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tidemark.operators.audit import layer_row_counts, processing_log
from tidemark.operators.bronze import normalise
from tidemark.operators.contracts import contracts_of
from tidemark.operators.quality import quality_summary
from tidemark.operators.resolve import resolve_cdc
from tidemark.plans import gold
from tidemark.plans.checks import layer_suite
from tidemark.sources.tables import StoredTable, append_rows
from tidemark.spec import DOMAINS, Contract
from tidemark.streaming.live import current_state

# Grain of every report.
GRAIN = {
    "payment_lifecycle": "payment_id",
    "payments_by_status": "event_name",
    "payment_funnel": "event_name",
    "driver_performance": "driver_id",
    "revenue_per_restaurant": "restaurant_id",
    "user_behavior": "cpf",
}


@dataclass
class Medallion:
    """Layered tables under ``root``.

    Bronze holds the newest version of every key, so an ``upsert`` Silver table is
    Bronze without its delete markers.  By default it is just that filter, read through
    to Bronze; ``materialise_silver`` writes a copy.  ``append`` and ``log`` contracts
    need the landing history and are always written.
    """

    spark: SparkSession
    root: str
    contracts: DataFrame | None = None
    threads: int = 8
    materialise_silver: bool = False
    domains: tuple[str, ...] = tuple(DOMAINS)
    results: list[tuple] = field(default_factory=list)
    known: dict[str, Contract] = field(default_factory=dict)

    def bronze_table(self, name: str) -> StoredTable:
        return StoredTable(self.spark, f"{self.root}/bronze/{name}", DOMAINS[name].key)

    def silver_table(self, name: str) -> StoredTable:
        return StoredTable(self.spark, f"{self.root}/silver/{name}", DOMAINS[name].key)

    def gold_table(self, name: str) -> StoredTable:
        return StoredTable(self.spark, f"{self.root}/gold/{name}", GRAIN[name])

    # ----------------------------------------------------------------- layers
    def build_bronze(self, name: str, batch: DataFrame) -> None:
        """Merge a landing batch; the newest version per key stays, deletes included."""
        self.bronze_table(name).merge(normalise(batch, DOMAINS[name]))

    def read_contracts(self) -> None:
        """Read the contracts of all domains, once for a run."""
        self.known = contracts_of([f"silver_{name}" for name in self.domains], self.contracts)

    def _contract(self, name: str) -> tuple[Contract, bool]:
        """Contract of a domain, and whether Bronze alone can answer it."""
        if not self.known:
            self.read_contracts()
        contract = self.known[f"silver_{name}"]
        latest = contract.cdc_strategy == "upsert" and contract.unique_key == DOMAINS[name].key
        return contract, latest

    def build_silver(self, name: str, landing: DataFrame) -> None:
        """Current state per contract."""
        contract, latest = self._contract(name)
        if not latest:
            rows = resolve_cdc(
                normalise(landing, DOMAINS[name]), contract.cdc_strategy, contract.unique_key
            )
            self.silver_table(name).overwrite(rows)
        elif self.materialise_silver:
            rows = current_state(self.bronze_table(name))
            self.silver_table(name).overwrite(rows)

    def read_silver(self, name: str) -> DataFrame:
        """A Silver table: the written copy, or Bronze without delete markers."""
        _, latest = self._contract(name)
        if latest and not self.materialise_silver:
            return current_state(self.bronze_table(name))
        return self.silver_table(name).read()

    def build_gold(self, name: str) -> None:
        """Rebuild a report; the payment lifecycle rewrites only what changed."""
        report, inputs = gold.REPORTS[name]
        sources = [self.read_silver(domain) for domain in inputs]
        table = self.gold_table(name)
        if name == "payment_lifecycle" and table.exists():
            changes = gold.payment_lifecycle_changes(sources[0], table.read()).persist()
            table.merge(changes.filter("change <> 'vanished'").drop("change"), order=())
            table.remove(changes.filter("change = 'vanished'").select("payment_id"))
            changes.unpersist()
        else:
            table.overwrite(report(*sources))

    # -------------------------------------------------------------------- run
    def run(self, batches: Mapping[str, DataFrame], landing: Mapping[str, DataFrame]) -> None:
        """Build all layers from the new ``batches`` and the whole ``landing`` history."""
        self.results = []
        self.read_contracts()
        self._together(
            [
                {
                    f"bronze_{name}": partial(self.build_bronze, name, batches[name]),
                    f"silver_{name}": partial(self.build_silver, name, landing[name]),
                }
                for name in self.domains
            ]
        )
        self._together([{f"gold_{name}": partial(self.build_gold, name)} for name in self.reports()])

    def _together(self, chains: Sequence[Mapping[str, Callable[[], None]]]) -> None:
        """Build independent chains side by side; a failure ends its own chain only."""

        def follow(chain: Mapping[str, Callable[[], None]]) -> None:
            for name, build in chain.items():
                began, clock = datetime.now(UTC), time.monotonic()
                status, message = "success", None
                try:
                    build()
                except Exception as failure:  # recorded here, raised when all chains ended
                    status, message = "error", str(failure)
                self.results.append((name, status, message, began, time.monotonic() - clock))
                if status == "error":
                    return

        with ThreadPoolExecutor(self.threads) as pool:
            for chain in chains:
                pool.submit(inheritable_thread_target(self.spark)(follow), chain)
        failed = sorted(name for name, status, *_ in self.results if status == "error")
        if failed:
            raise RuntimeError(f"models failed: {', '.join(failed)}")

    # -------------------------------------------------------------- afterwards
    def reports(self) -> list[str]:
        """Reports whose Silver tables are part of this run."""
        return [name for name, (_, needs) in gold.REPORTS.items() if set(needs) <= set(self.domains)]

    def tables(self) -> dict[str, DataFrame]:
        """Every built table by model name."""
        loads = {f"bronze_{name}": self.bronze_table(name).read for name in self.domains}
        loads |= {f"silver_{name}": partial(self.read_silver, name) for name in self.domains}
        loads |= {f"gold_{name}": self.gold_table(name).read for name in self.reports()}
        with ThreadPoolExecutor(self.threads) as pool:
            return dict(zip(loads, pool.map(lambda load: load(), loads.values())))

    def check(self) -> DataFrame:
        """Verdict of every check of every layer."""
        return quality_summary(layer_suite(self.tables()))

    def log(self, run_id: str) -> DataFrame:
        """Append this run to the processing log and return its rows."""
        results = self.spark.createDataFrame(
            [
                (
                    run_id,
                    f"model.tidemark.{name}",
                    status,
                    seconds,
                    message,
                    [("execute", began.isoformat(), (began + timedelta(seconds=seconds)).isoformat())],
                )
                for name, status, message, began, seconds in self.results
            ],
            "invocation_id string, unique_id string, status string, execution_time double, message string, "
            "timing array<struct<name:string,started_at:string,completed_at:string>>",
        )
        rows = processing_log(
            results, layer_row_counts(self.tables()), run_id, F.current_timestamp()
        )
        append_rows(rows, f"{self.root}/processing_log")
        return rows
