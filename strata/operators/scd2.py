"""History of slowly changing rows: half-open validity intervals per key.

``__START_AT`` is the row's sequence value and ``__END_AT`` the next one of its
key, NULL while current. Arrival order does not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, TimestampNTZType, TimestampType

from strata.operators.quality import expect_fail
from strata.operators.windows import latest_per_key, neighbour

START, END = "__START_AT", "__END_AT"
MERGED = "__MERGED"  # the version repeats the one before it in all tracked columns


def _split_for(df: DataFrame, sequence_by: str) -> Column | None:
    """How to cut a key's rows into pieces of bounded size.

    After deduplication a key has one row per sequence value. Dates therefore
    bound a key by the calendar and need no cut; finer types are cut into ranges.
    """
    kind = df.schema[sequence_by].dataType
    if isinstance(kind, DateType):
        return None
    if isinstance(kind, TimestampNTZType):
        # Counted without a zone: through one, a skipped hour would change the order.
        return F.unix_date(F.col(sequence_by).cast("date")) * 24 + F.hour(sequence_by)
    if isinstance(kind, TimestampType):
        return F.date_trunc("hour", F.col(sequence_by))
    if isinstance(kind, IntegralType):
        return F.floor(F.col(sequence_by) / 100_000)
    raise TypeError(f"sequence column {sequence_by} must be a date, timestamp or integer")


def scd2_history(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    tie_break: Sequence[Column],
    tracked: Sequence[str] | None = None,
) -> DataFrame:
    """All versions of every key.

    Rows that share key and sequence value collapse to the first under ``tie_break``.
    With ``tracked``, neighbouring versions equal in those columns merge and keep
    the earliest start.
    """
    if tracked is not None:
        return scd2_merged(scd2_versions(df, keys, sequence_by, tie_break, tracked), keys, sequence_by, tracked)
    rows = _versions(df, keys, sequence_by, tie_break)
    dated = neighbour(rows, keys, sequence_by, F.col(sequence_by), END, split=_split_for(df, sequence_by))
    return dated.withColumn(START, F.col(sequence_by)).select(*rows.columns, START, END)


def _versions(df: DataFrame, keys: Sequence[str], sequence_by: str, tie_break: Sequence[Column]) -> DataFrame:
    sound = expect_fail(df, {f"{sequence_by} is set": F.col(sequence_by).isNotNull()})
    return latest_per_key(sound, [*keys, sequence_by], tie_break)


def scd2_versions(
    df: DataFrame, keys: Sequence[str], sequence_by: str, tie_break: Sequence[Column], tracked: Sequence[str]
) -> DataFrame:
    """All versions with all their columns, those that merge into the one before marked by ``__MERGED``.

    Kept as a table, this is all that a later batch needs: a late row may split what was
    merged, or merge what was apart. The others have the interval up to the next one that
    does not merge.
    """
    split, rows = _split_for(df, sequence_by), _versions(df, keys, sequence_by, tie_break)
    state = F.struct(*tracked)
    marked = neighbour(rows, keys, sequence_by, state, "_previous", ahead=False, split=split)
    marked = marked.withColumn(MERGED, F.col("_previous").eqNullSafe(state)).drop("_previous")
    dated = neighbour(marked, [*keys, MERGED], sequence_by, F.col(sequence_by), END, split=split)
    dated = dated.withColumns({START: F.col(sequence_by), END: F.when(~F.col(MERGED), F.col(END))})
    return dated.select(*rows.columns, START, END, MERGED)


def scd2_merged(versions: DataFrame, keys: Sequence[str], sequence_by: str, tracked: Sequence[str]) -> DataFrame:
    """The history over the ``tracked`` columns from marked versions."""
    columns = dict.fromkeys([*keys, sequence_by, *tracked])
    return versions.filter(~F.col(MERGED)).select(*columns, START, END)


def scd2_apply(
    history: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    tie_break: Sequence[Column],
    tracked: Sequence[str] | None = None,
) -> DataFrame:
    """Fold a batch into a history; only the keys of the batch are rebuilt.

    The batch may bring new columns; rows from before have NULL in them. With ``tracked``,
    history and result are marked versions (``scd2_versions``), read by ``scd2_merged``.
    """
    touched = batch.select(*keys).distinct()
    untouched = history.join(touched, list(keys), "left_anti")
    known = history.join(touched, list(keys), "left_semi").drop(START, END, MERGED)
    rows = known.unionByName(batch, allowMissingColumns=True)
    how = (rows, keys, sequence_by, tie_break)
    rebuilt = scd2_history(*how) if tracked is None else scd2_versions(*how, tracked)
    return untouched.unionByName(rebuilt, allowMissingColumns=True)


def scd2_current(history: DataFrame) -> DataFrame:
    """Rows still valid."""
    return history.filter(F.col(END).isNull())


def scd2_as_of(history: DataFrame, moment: Column) -> DataFrame:
    """Rows valid at ``moment``."""
    return history.filter((F.col(START) <= moment) & (F.col(END).isNull() | (F.col(END) > moment)))
