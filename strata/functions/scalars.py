"""Column expressions shared by the layers; all of them stay inside codegen."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status bands of a health score.
ATTENTION_BELOW = 70
MONITOR_BELOW = 80
# The parts of an exact sum, from whole numbers down, each in units of the last by LIMB.
LIMBS = ("whole", "fine", "finer", "finest")
LIMB = float(2**31)


def safe_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, NULL where the divisor is zero."""
    return top / F.nullif(bottom, F.lit(0))


def limbs(value: Column | str) -> list[Column]:
    """A double as whole numbers of 1, 2**-31, 2**-62 and 2**-93, without any rounding.

    Each step takes the whole part and scales the rest by a power of two, which is exact. A
    value that needs finer units (full precision below 1e-12), or is no finite number
    below 2**63, is an error and not a wrong total.
    """
    rest, parts = _col(value).cast("double"), []
    for scale in (1.0, LIMB, LIMB, LIMB):
        rest = rest * F.lit(scale)
        parts.append(rest.cast("bigint"))  # towards zero; out of range is an error
        rest = rest - parts[-1]
    too_fine = F.raise_error(F.lit("a value has more digits than an exact sum holds")).cast("bigint")
    return [*parts[:-1], F.when(rest != 0, too_fine).otherwise(parts[-1])]


def exact_sum(value: Column | str, weight: Column | None = None, wide: bool = False) -> Column:
    """Aggregate: the sum of doubles as limbs, equal for every order, partitioning and retry.

    64 bits hold the limbs of 4e9 rows and more are an error; ``wide`` sums decimals
    instead, for any number of rows. ``weight`` counts a value that often.
    """
    parts = [p if weight is None else p * weight for p in limbs(value)]
    return F.struct(*(F.sum(p.cast("decimal(20,0)") if wide else p).alias(n) for p, n in zip(parts, LIMBS, strict=True)))


def add_sums(sums: Column | str) -> Column:
    """Aggregate: the total of ``carried`` sums."""
    return F.struct(*(F.sum(_col(sums).getField(n)).alias(n) for n in LIMBS))


def carried(sums: Column | str) -> Column:
    """The same sum with all limbs but the first below 2**31, so that as many sums can be added again."""
    carry, parts = F.lit(0).cast("bigint"), []
    for name in reversed(LIMBS[1:]):
        total = _col(sums).getField(name) + carry
        parts.append((total % F.lit(2**31)).cast("bigint"))
        carry = F.call_function("div", total, F.lit(2**31).cast("bigint"))
    parts.append((_col(sums).getField(LIMBS[0]) + carry).cast("bigint"))
    return F.struct(*(p.alias(n) for p, n in zip(reversed(parts), LIMBS, strict=True)))


def sum_value(sums: Column | str, is_carried: bool = False) -> Column:
    """A sum of limbs as a double; NULL where there was nothing to sum. ``is_carried`` says that it is ``carried``."""
    held = _col(sums) if is_carried else carried(sums)
    top, low = held.getField(LIMBS[0]), held.getField(LIMBS[1]) * F.lit(2**31) + held.getField(LIMBS[2])
    # both parts with one sign: else the small digits of a difference would be lost
    step = F.when((top > 0) & (low < 0), -1).when((top < 0) & (low > 0), 1).otherwise(0)
    rest = (low - step * F.lit(2**62)).cast("double") + held.getField(LIMBS[3]).cast("double") / F.lit(LIMB)
    return (top + step).cast("double") + rest / F.lit(LIMB * LIMB)


def money_sum(amount: Column | str) -> Column:
    """Exact total of a column of doubles over any number of rows."""
    return sum_value(exact_sum(amount, wide=True))


def health_band(score: Column | str) -> Column:
    """Status text of a health score."""
    score = _col(score)
    return (
        F.when(score < ATTENTION_BELOW, "Needs Attention")
        .when(score < MONITOR_BELOW, "Monitor")
        .otherwise("Operational")
    )


def month_start(day: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.date_trunc("month", _col(day)).cast("date")


def within_days(as_of: dt.date, days: int, day: str, moment: str | None = None) -> Column:
    """``as_of - days <= day <= as_of``.

    With ``moment`` (the timestamp that ``day`` is taken from) the same range is
    also stated on it, so that a file scan can use whichever of the two it stores.
    """
    first = as_of - dt.timedelta(days=days)
    inside = F.col(day).between(F.lit(first), F.lit(as_of))
    if moment is None:
        return inside
    return inside & moment_range(moment, first, as_of + dt.timedelta(days=1))


def moment_range(moment: str, start: dt.date, stop: dt.date) -> Column:
    """Half-open ``[start, stop)`` on a zone-free timestamp; reaches the scan as a range filter."""
    return (F.col(moment) >= _ntz(start)) & (F.col(moment) < _ntz(stop))


def slugify(text: Column | str) -> Column:
    """Lower case, each run of other characters one underscore, none at the ends."""
    return F.regexp_replace(
        F.regexp_replace(F.lower(_col(text)), "[^a-z0-9]+", "_"), "^_|_$", ""
    )


def json_path(document: Column | str, path: str, data_type: str = "string") -> Column:
    """One value of a JSON text; NULL when absent or of another type."""
    return F.get_json_object(_col(document), path).try_cast(data_type)


def variant_path(document: Column | str, path: str, data_type: str = "string") -> Column:
    """The same through a parsed VARIANT, which keeps types and nested values apart."""
    return F.try_variant_get(F.try_parse_json(_col(document)), path, data_type)


def json_size(document: Column | str, path: str) -> Column:
    """Number of elements of a JSON array inside a document, such as its pages."""
    return F.json_array_length(F.get_json_object(_col(document), path))


def stable_id(*parts: Column | str) -> Column:
    """Repeatable identifier of the given parts (a retried task writes the same one)."""
    texts = [_col(p).cast("string") for p in parts]
    # with its length before it, no part can run into the next, and NULL is no text
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def unit_hash(*keys: Column | str) -> Column:
    """A number in [0, 1) fixed by the keys, whatever the partitioning or the attempt."""
    digest = F.md5(F.concat_ws("|", *[_col(k).cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))


def run_stamp(run_ts: dt.datetime | None) -> Column:
    """The given load time, or the start of the query."""
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")


def _ntz(day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast("timestamp_ntz")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
