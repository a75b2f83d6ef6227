"""Change-data-capture medallion operators for Spark DataFrames and streams.

Layers
------
``functions``  column expressions (no shuffles, no Python workers)
``sources``    readers, writers and keyed snapshots
``operators``  DataFrame -> DataFrame building blocks
``plans``      whole reports and the Bronze -> Silver -> Gold run
``streaming``  Structured Streaming forms of the same operators
"""

from tidemark.spec import CONTROL_COLUMNS, DOMAINS, Contract, DomainSpec

__all__ = ["CONTROL_COLUMNS", "DOMAINS", "Contract", "DomainSpec"]
