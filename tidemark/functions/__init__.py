"""Column expressions used by every layer."""

from tidemark.functions.scalar import (
    TRACE_COLUMNS,
    amount,
    average,
    bucket_start,
    cents,
    declared_field,
    digits_modulo,
    epoch_ms,
    epoch_text_to_ms,
    identifier,
    is_delete,
    ms_to_ntz,
    ratio,
    seconds_between,
    version_struct,
)

__all__ = [
    "TRACE_COLUMNS",
    "amount",
    "average",
    "bucket_start",
    "cents",
    "declared_field",
    "digits_modulo",
    "epoch_ms",
    "epoch_text_to_ms",
    "identifier",
    "is_delete",
    "ms_to_ntz",
    "ratio",
    "seconds_between",
    "version_struct",
]
