"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, hash_of, named, store

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
GROUP = 64
CLASS = ("doc_id", "source", "size", "mark")


def classes(docs: DataFrame) -> DataFrame:
    """Rows that agree in id, source and text as one class with its number of ``rows``.

    The mark is a hash of the text; the size its number of words (null: 0). Map tasks
    count repeated rows before the shuffle.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), size.alias("size"), F.xxhash64("text").alias("mark"))
    return rows.groupBy(*CLASS).agg(F.count(F.lit(1)).alias("rows"))


def targets(units: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """One row per source: source, source_size, units, target.

    Sources by code point, null last, take the weights in turn and share ``share`` of all
    words. A target stops at ``most`` times its source; the excess goes to the others by
    weight. With sources in order of cap over weight, the full ones come first, so
    running sums give the level at which the rest is filled. There is one row per source,
    a list someone has set weights for, so one ordered window holds it.
    """
    sources = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("units"))
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    rows = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double"))
    rows = rows.withColumn("cap", most * F.col("source_size").cast("double")).withColumn("fills_at", F.col("cap") / F.col("weight"))
    order = Window.orderBy("fills_at", F.asc_nulls_last("source"))
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("level", level)
    open_level = F.first(F.when(F.col("fills_at") > F.col("level"), F.col("level")), ignorenulls=True).over(every)
    rows = rows.withColumn("open_level", open_level)
    target = F.coalesce(F.least("cap", F.col("open_level") * F.col("weight")), F.col("cap"))
    return rows.select("source", "source_size", "units", target.alias("target"))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def integral(unit: Column) -> Column:
    return (unit["mass"] <= 0) | (unit["mass"] >= unit["size"])


def with_mass(unit: Column, mass: Column) -> Column:
    fields = [unit[c].alias(c) for c in ("seed", "doc_id", "size", "mark", "rows")]
    return F.struct(*fields, mass.alias("mass"))


def transfer(state: Column, unit: Column) -> Column:
    """Pair the unit still open with the next one and move words between them.

    The move fills or empties one of the two. Its direction is drawn so that each keeps
    its expected words; their sum stays as it is.
    """
    held = state["held"]
    room, other_room = held["size"] - held["mass"], unit["size"] - unit["mass"]
    up, down = F.least(room, unit["mass"]), F.least(held["mass"], other_room)
    draw = F.xxhash64(held["seed"], unit["seed"]).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))
    first = F.when(draw * (up + down) < down, F.when(room <= unit["mass"], held["size"]).otherwise(held["mass"] + unit["mass"]))
    first = first.otherwise(F.when(held["mass"] <= other_room, F.lit(0.0)).otherwise(held["mass"] - other_room))
    second = F.when(draw * (up + down) < down, F.when(unit["mass"] <= room, F.lit(0.0)).otherwise(unit["mass"] - room))
    second = second.otherwise(F.when(other_room <= held["mass"], unit["size"]).otherwise(unit["mass"] + held["mass"]))

    def settle(pair: Column) -> Column:
        closed = integral(pair["b"])
        return F.struct(
            F.when(closed, pair["a"]).otherwise(pair["b"]).alias("held"),
            F.concat(state["done"], F.array(F.when(closed, pair["b"]).otherwise(pair["a"]))).alias("done"),
        )

    moved = let(F.struct(with_mass(held, first).alias("a"), with_mass(unit, second).alias("b")), settle)
    passed = F.struct(unit.alias("held"), F.concat(state["done"], F.array(held)).alias("done"))
    return F.when(integral(held), passed).otherwise(moved)


def rounding(units: DataFrame, largest: int) -> DataFrame:
    """Round the masses of all units to 0 or their size, source by source.

    A reduction tree: groups of about GROUP units of one source are folded, each leaves at
    most one open unit, and these meet again in the next level, until each source has one
    group. ``largest`` is the number of units of the largest source. The last open unit of
    a source keeps its fraction.
    """
    done = units.filter(integral(F.col("unit")))
    now, level = units.filter(~integral(F.col("unit"))), 0
    while True:
        largest = max(1, -(-largest // GROUP))
        n = F.greatest(F.lit(1), F.ceil(F.col("units") / float(GROUP ** (level + 1))))
        bucket = F.pmod(F.xxhash64("unit.seed", F.lit(level)), n)
        groups = now.groupBy("source", "units", bucket.alias("bucket")).agg(F.array_sort(F.collect_list("unit")).alias("all"))
        start = F.struct(F.col("all")[0].alias("held"), F.filter("all", lambda u: u["size"] < 0).alias("done"))
        rest = F.slice("all", F.lit(2), F.size("all"))
        fold = F.aggregate(rest, start, transfer)
        folded = store(groups.select("source", "units", fold.alias("state")), "mixing")
        done = done.unionByName(folded.select("source", "units", F.explode("state.done").alias("unit")))
        now, level = folded.select("source", "units", F.col("state.held").alias("unit")), level + 1
        if largest == 1:
            return done.unionByName(now)


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 1) -> DataFrame:
    """How many words of each document a mix with the given source weights takes.

    Returns one row per class of equal rows: doc_id, source, size, mark, rows, source_size,
    target, whole (copies that each of its rows gives), more (rows that give one more) and
    part (words of one further copy; at most one per source is cut). A source's taken words
    are its target to within a word. Texts without words and null texts have size 0 and
    nothing is taken; a null source is a source, null ids are allowed. Draws are hashes,
    so reruns and retried tasks agree. An empty table gives no rows.
    """
    units = store(classes(docs), "mixing")
    sources = store(targets(units, weights, share, most), "mixing")
    largest = sources.agg(F.max("units")).first()[0] or 0
    joined = units.withColumnRenamed("source", "of").join(sources, F.col("of").eqNullSafe(F.col("source"))).drop("of")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = joined.withColumn("whole", F.floor(copies)).withColumn("open", (copies - F.floor(copies)) * F.col("rows"))
    mass = (F.col("open") - F.floor("open")) * F.col("size")
    key = F.xxhash64("doc_id", "mark", "size", F.lit(seed))
    unit = F.struct(key.alias("seed"), "doc_id", F.col("size").cast("double").alias("size"), "mark", "rows", mass.alias("mass"))
    rounded = rounding(joined.select("source", "units", unit.alias("unit")), largest)
    flat = rounded.select("source", "unit.doc_id", F.col("unit.size").cast("long").alias("size"), "unit.mark", "unit.rows", F.round("unit.mass").cast("long").alias("last"))
    flat = flat.withColumnRenamed("source", "of").join(sources, F.col("of").eqNullSafe(F.col("source"))).drop("of")
    flat = flat.withColumn("whole", F.floor(copies)).withColumn("open", F.floor((copies - F.floor(copies)) * F.col("rows")))
    full = (F.col("last") == F.col("size")) & (F.col("size") > 0)
    return flat.select(
        *CLASS, "rows", "source_size", "target", "whole",
        (F.col("open") + full.cast("long")).alias("more"),
        F.when(full, 0).otherwise(F.col("last")).cast("long").alias("part"),
    )


def taken(mixed: DataFrame) -> DataFrame:
    """One row per document row: doc_id, size, source_size, target, taken."""
    number = F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("number")
    rows = mixed.select("*", number)
    extra = F.when(F.col("number") <= F.col("more"), F.col("size")).when(F.col("number") == F.col("more") + 1, F.col("part")).otherwise(0)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + extra).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents as often as the mix takes them, with their columns.

    All copies of a class come from one of its rows; a cut copy keeps its first words.
    """
    names = docs.columns
    took = mixture(docs.select("doc_id", "source", "text"), **options)
    took = took.select(
        F.struct(F.col("doc_id").alias("i"), F.col("source").alias("s"), F.col("mark").alias("m")).alias("_class"),
        (F.col("whole") * F.col("rows") + F.col("more")).cast("int").alias("_full"), F.col("part").cast("int").alias("_part"),
    ).filter("_full > 0 OR _part > 0")
    own = F.struct(F.col("doc_id").cast("long").alias("i"), F.col("source").cast("string").alias("s"), F.xxhash64("text").alias("m"))
    rest = hash_of(docs, [c for c in names if c != "text"])  # of several rows always the same one
    one = docs.select(own.alias("_class"), F.struct(*map(named, names)).alias("_row"), rest.alias("_rest"))
    one = one.groupBy("_class").agg(F.min_by("_row", "_rest").alias("_row"))
    cut = F.array_join(F.slice(F.regexp_extract_all("_row.text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("_part")), " ")
    copies = F.concat(
        F.array_repeat(F.col("_row.text"), F.col("_full")),
        F.when(F.col("_part") > 0, F.array(cut)).otherwise(F.array().cast("array<string>")),
    )
    rows = one.join(took, "_class").select("_row", F.explode(copies).alias("_text"))
    return rows.select(*(F.col("_text").alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in names))
