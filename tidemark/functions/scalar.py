"""Scalar expressions.

All of them are built from Spark SQL functions, so they stay inside whole-stage
code generation.  Money is carried as integer hundredths (``bigint``) between
aggregation steps: integer sums do not depend on row order, so a re-run of a lost
task gives the same digits, and they are far cheaper than wide decimals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tie-break columns of a change row, most significant first.
TRACE_COLUMNS = ("source_ts_ms", "kafka_offset", "kafka_partition")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --------------------------------------------------------------------- changes
def is_delete(op: Column | str = "op") -> Column:
    """True only for an explicit delete; a NULL ``op`` is not a delete."""
    return _col(op).eqNullSafe(F.lit("d"))


def version_struct(order: Sequence[str]) -> Column:
    """Comparable version of a row; NULL parts sort lowest."""
    return F.struct(*[F.col(name) for name in order])


# ------------------------------------------------------------------- timestamps
def epoch_ms(ts: Column | str) -> Column:
    """Epoch milliseconds of a zone-less timestamp, whatever the session zone is."""
    ts = _col(ts)
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    millis = F.floor(F.date_part(F.lit("SECOND"), ts) * 1000).cast("bigint")
    return (
        days * F.lit(86_400_000).cast("bigint")
        + F.hour(ts).cast("bigint") * 3_600_000
        + F.minute(ts).cast("bigint") * 60_000
        + millis
    )


def ms_to_ntz(ms: Column | str) -> Column:
    """Zone-less timestamp of epoch milliseconds."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + _col(ms).cast("bigint") * F.expr("INTERVAL '0.001' SECOND")


def bucket_start(ts: Column | str, seconds: int) -> Column:
    """Start of the fixed-width bucket a zone-less timestamp falls into."""
    ms = epoch_ms(ts)
    return ms_to_ntz(ms - F.pmod(ms, F.lit(seconds * 1000).cast("bigint")))


def epoch_text_to_ms(text: Column | str) -> Column:
    """``1759687600000`` and ``1.7596876e12`` both become the same bigint.

    Malformed text becomes NULL, to be reported by the not-null check instead of
    failing the whole job.
    """
    return F.floor(_col(text).try_cast("double") + F.lit(0.5)).cast("bigint")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Number of second boundaries between two zone-less timestamps."""
    begin = F.floor(epoch_ms(start) / F.lit(1000)).cast("bigint")
    finish = F.floor(epoch_ms(end) / F.lit(1000)).cast("bigint")
    return finish - begin


# ------------------------------------------------------------ exact arithmetic
def cents(value: Column | str) -> Column:
    """Integer hundredths of a two-decimal number."""
    return F.floor(_col(value).cast("double") * F.lit(100.0) + F.lit(0.5)).cast("bigint")


def amount(hundredths: Column | str) -> Column:
    """Back from integer hundredths to a double."""
    return _col(hundredths).cast("double") / F.lit(100.0)


def _half_up(numerator: Column, denominator: Column) -> Column:
    """``round(numerator / denominator)`` on bigints, halves away from zero."""
    size = F.abs(denominator)
    quotient = F.call_function("div", F.abs(numerator) * 2 + size, size * 2)
    return quotient * F.signum(numerator).cast("bigint") * F.signum(denominator).cast("bigint")


def ratio(numerator: Column | str, denominator: Column | str, scale: int = 1) -> Column:
    """``round(scale * numerator / denominator, 2)`` computed on integers.

    A zero denominator gives NULL.  ``scale=100`` turns the ratio into a percentage.
    """
    bottom = F.nullif(_col(denominator).cast("bigint"), F.lit(0).cast("bigint"))
    top = _col(numerator).cast("bigint") * F.lit(100 * scale).cast("bigint")
    return amount(_half_up(top, bottom))


def average(total_hundredths: Column | str, count: Column | str) -> Column:
    """``round(avg(x), 2)`` from a sum of hundredths and a count of non-null values."""
    bottom = F.nullif(_col(count).cast("bigint"), F.lit(0).cast("bigint"))
    return amount(_half_up(_col(total_hundredths).cast("bigint"), bottom))


# ------------------------------------------------------------------------ text
def identifier(name: str) -> str:
    """Landing tables carry upper-case column names."""
    return name.upper()


def declared_field(doc: Column | str, field: str) -> Column:
    """Value of ``field`` in a ``k=v,k=v`` text, NULL when it is not declared.

    Blanks around keys and values are dropped, the value may itself contain ``=``,
    and the last declaration of a repeated key wins.
    """
    parts = F.split(_col(doc), ",")
    matching = F.filter(
        parts,
        lambda part: F.contains(part, F.lit("="))
        & (F.trim(F.substring_index(part, "=", 1)) == F.lit(field)),
    )
    last = F.try_element_at(matching, F.lit(-1))
    return F.trim(F.substring(last, F.locate("=", last) + 1, F.length(last)))


def digits_modulo(key: Column | str, buckets: int = 354) -> Column:
    """Digits of an alphanumeric key, modulo ``buckets``, plus one, as text.

    An empty or NULL key stays NULL; a key without digits maps to ``1``.  Keys of up
    to 18 digits use plain integer arithmetic, longer ones fold digit by digit.
    """
    key = _col(key)
    digits = F.regexp_replace(key, "[^0-9]", "")
    short = F.when(digits == "", F.lit(0).cast("bigint")).otherwise(digits.try_cast("bigint"))
    modulus = F.lit(buckets).cast("bigint")
    folded = F.aggregate(
        F.filter(F.split(digits, ""), lambda digit: digit != ""),
        F.lit(0).cast("bigint"),
        lambda acc, digit: (acc * 10 + digit.try_cast("bigint")) % modulus,
    )
    remainder = F.when(F.length(digits) <= 18, short % modulus).otherwise(folded)
    return F.when(F.length(key) > 0, (remainder + 1).cast("string"))
