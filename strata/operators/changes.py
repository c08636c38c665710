"""Upserts, deletes and keyed change feeds over immutable snapshots.

Plain files take no row-level updates, so each operator returns the next
snapshot. Key columns must be non-null (state it with ``expect_fail``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.scalars import unit_hash
from strata.operators.quality import require_unique
from strata.operators.windows import latest_per_key

# Change types of a feed and the column prefixes it adds.
INSERT, PREIMAGE, POSTIMAGE, DELETE = "insert", "update_preimage", "update_postimage", "delete"
FEED_PREFIXES = ("_change", "_commit")


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[Column] | None = None
) -> DataFrame:
    """Replace matching target rows by source rows and add the rest.

    With ``order_by`` the source may repeat keys and its first row per key wins.
    """
    if order_by is not None:
        source = latest_per_key(source, keys, order_by)
    kept = delete_matching(target, source, keys, unique=True)
    return kept.unionByName(source, allowMissingColumns=True)


def merge_update(
    target: DataFrame, source: DataFrame, keys: Sequence[str], assignments: dict[str, Column]
) -> DataFrame:
    """Update matched rows only.

    Assignments refer to ``t.<column>`` and ``s.<column>``; all of them read the row
    as it was before the update. A target row matched twice aborts the job.
    """
    marked = require_unique(source, keys).withColumn("_hit", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    hit = F.col("s._hit").isNotNull()
    types = {f.name: f.dataType for f in target.schema}
    columns = [
        F.when(hit, assignments[c].cast(types[c])).otherwise(F.col(f"t.{c}")).alias(c)
        if c in assignments
        else F.col(f"t.{c}")
        for c in target.columns
    ]
    return target.alias("t").join(marked, on, "left").select(*columns)


def delete_matching(
    target: DataFrame, doomed: DataFrame, keys: Sequence[str], unique: bool = False
) -> DataFrame:
    """Target rows whose key is not among the doomed."""
    return target.join(_key_set(doomed, keys, unique), list(keys), "left_anti")


def semi_keys(target: DataFrame, wanted: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """Target rows whose key is among the wanted."""
    return target.join(_key_set(wanted, keys, unique), list(keys), "left_semi")


def _key_set(df: DataFrame, keys: Sequence[str], unique: bool) -> DataFrame:
    """Each key once: copies of a hot key end in the map tasks, and the join can
    reuse the shuffle of the distinct. Not needed where keys are unique already."""
    return df.select(*keys) if unique else df.select(*keys).distinct()


def change_feed(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    version: Column | int,
    commit_ts: Column | dt.datetime,
) -> DataFrame:
    """Row changes that turn one keyed snapshot into the next.

    One full join on the (unique) key; equal rows fall out before anything is
    expanded, and an update becomes a pre- and a post-image. A column that only one
    of the snapshots has is NULL in the other.
    """
    old, new = _widened(old, new), _widened(new, old)
    payload = [c for c in old.columns if c not in keys]
    changed = (
        old.select(*keys, F.struct(*payload).alias("_old"))
        .join(new.select(*keys, F.struct(*payload).alias("_new")), list(keys), "full_outer")
        .filter(~F.col("_old").eqNullSafe(F.col("_new")))
    )

    def image(kind: str, side: str) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), F.col(side).alias("_row"))

    images = (
        F.when(F.col("_old").isNull(), F.array(image(INSERT, "_new")))
        .when(F.col("_new").isNull(), F.array(image(DELETE, "_old")))
        .otherwise(F.array(image(PREIMAGE, "_old"), image(POSTIMAGE, "_new")))
    )
    stamp = commit_ts if isinstance(commit_ts, Column) else F.lit(commit_ts)
    number = version if isinstance(version, Column) else F.lit(version)
    return (
        changed.select(*keys, F.explode(images).alias("_image"))
        .select(*keys, "_image._row.*", "_image._change_type")
        .withColumns(
            {"_commit_version": number.cast("long"), "_commit_timestamp": stamp.cast("timestamp")}
        )
    )


def _widened(df: DataFrame, other: DataFrame) -> DataFrame:
    """``df`` with the columns only ``other`` has."""
    extra = [f for f in other.schema if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in extra}) if extra else df


def strip_meta(feed: DataFrame) -> DataFrame:
    """The source columns of a feed."""
    return feed.select(*[c for c in feed.columns if not c.startswith(FEED_PREFIXES)])


def upserts(feed: DataFrame) -> DataFrame:
    """Rows of a feed that carry a new value."""
    return feed.filter(F.col("_change_type").isin(INSERT, POSTIMAGE))


def net_changes(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last change of each key: a delete, or the values it ends with.

    Within one version a new value outranks a delete, so a key deleted and
    inserted again ends as an upsert.
    """
    final = feed.filter(F.col("_change_type") != PREIMAGE)
    is_delete = F.col("_change_type") == DELETE
    return latest_per_key(final, keys, [F.desc("_commit_version"), is_delete.asc(), F.desc("_commit_timestamp")])


def as_mirror_rows(changes: DataFrame) -> DataFrame:
    """Upserted rows as the mirror stores them."""
    rows = upserts(changes)
    plain = [c for c in rows.columns if not c.startswith(FEED_PREFIXES)]
    return rows.select(
        *plain,
        F.col("_change_type").alias("_cdc_type"),
        F.col("_commit_timestamp").alias("_cdc_timestamp"),
    )


def cdc_mirror(target: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Apply a feed to a mirror by its net changes, deletes included."""
    return apply_net(target, net_changes(feed, keys), keys)


def apply_net(target: DataFrame, net: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Apply net changes, one per key. They are read twice, so store costly ones first."""
    kept = delete_matching(target, net, keys, unique=True)
    return kept.unionByName(as_mirror_rows(net), allowMissingColumns=True)


def audit_append(feed: DataFrame) -> DataFrame:
    """The rows an append-only audit log receives from a feed; deletes are ignored."""
    rows = upserts(feed)
    plain = [c for c in rows.columns if not c.startswith(FEED_PREFIXES)]
    return rows.select(
        *plain,
        F.upper("_change_type").alias("_operation"),
        "_commit_version",
        "_commit_timestamp",
    )


def audit_latest(audit: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest audited value per key."""
    return latest_per_key(audit, keys, [F.desc("_commit_version"), F.desc("_commit_timestamp")])


def align_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns in the order and types of ``schema``; a missing column becomes NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def key_sample(df: DataFrame, keys: Sequence[str], fraction: float) -> DataFrame:
    """About ``fraction`` of the keys, without replacement and the same on every run."""
    return df.filter(unit_hash(*keys) < fraction)
