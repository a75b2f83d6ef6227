"""All registered queries and oracles by name."""

from __future__ import annotations

from workloads import governance, incremental, landing, layers, live, reports, streams

_MODULES = (layers, landing, reports, incremental, governance, streams, live)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
