"""Row numbers and running aggregates over a whole table, or a key that is most of it, without a single task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuefold.columns import free
from cuefold.storage import written

_IN_PARTITION = 33  # bits of monotonically_increasing_id that count within a partition


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with `name`, from 1 in the given order (which should be total).

    Rows are sorted by ranges and keep their place in their range; the ranges' sizes, one row for each
    partition, give the offsets."""
    free(df, name, "_at", "_part", "_before")
    rows = written(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    sizes = rows.groupBy(F.shiftright("_at", _IN_PARTITION).alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    held = rows.withColumn("_part", F.shiftright("_at", _IN_PARTITION)).join(F.broadcast(before), "_part")
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << _IN_PARTITION) - 1)) + 1
    return held.withColumn(name, place).drop("_at", "_part", "_before")


#: Running aggregates: over rows of a range, over the ranges' totals, and of both.
_SCANS = {
    "sum": (F.sum, F.sum, lambda local, carry: F.when(local.isNotNull() | carry.isNotNull(), F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0)))),
    "min": (F.min, F.min, lambda local, carry: F.least(local, carry)),
    "max": (F.max, F.max, lambda local, carry: F.greatest(local, carry)),
    "last": (F.last, lambda c: F.max_by(c, "_at"), lambda local, carry: F.coalesce(local, carry)),
}


def scanned(df: DataFrame, key: list[str], order: list[Column], scans: dict[str, tuple[str, Column, bool]]) -> DataFrame:
    """df with a column for each scan (sum, min, max or last; what of; whether the row itself counts) over the rows of its key so far.

    Rows are sorted by key and `order` (total within a key) into ranges of like size, so a key that holds most rows fills many of
    them. Each range is scanned on its own; what a key carries into a range is the aggregate of its earlier ranges. Only the first
    key of a range has any, so what is carried is a row for each range at most, and is broadcast. `last` is for values without nulls."""
    free(df, *scans, "_at", "_part", "_of", *[f"_{x}{i}" for x in "xc" for i in range(len(scans))], *[f"_k{j}" for j in range(len(key))])
    columns = {f"_x{i}": x for i, (_, x, _) in enumerate(scans.values())}
    rows = written(df.withColumns(columns).orderBy(*key, *order).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    rows = rows.withColumn("_part", F.shiftright("_at", _IN_PARTITION))
    totals = rows.groupBy("_part", *key).agg(*[_SCANS[kind][1](F.col(f"_x{i}")).alias(f"_t{i}") for i, (kind, _, _) in enumerate(scans.values())])
    earlier = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        F.col("_part").alias("_of"), *[F.col(k).alias(f"_k{j}") for j, k in enumerate(key)], F.count("*").over(earlier).alias("_met"),
        *[_SCANS[kind][0](f"_t{i}").over(earlier).alias(f"_c{i}") for i, (kind, _, _) in enumerate(scans.values())],
    ).where("_met > 0").drop("_met")
    same = F.col("_part") == F.col("_of")
    for j, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{j}"))
    held = rows.join(F.broadcast(carried), same, "left")
    own = Window.partitionBy("_part", *key).orderBy("_at")
    for i, (name, (kind, _, itself)) in enumerate(scans.items()):
        local = _SCANS[kind][0](f"_x{i}").over(own.rowsBetween(Window.unboundedPreceding, 0 if itself else -1))
        held = held.withColumn(name, _SCANS[kind][2](local, F.col(f"_c{i}")))
    return held.drop("_at", "_part", "_of", *[f"_k{j}" for j in range(len(key))], *[f"_{x}{i}" for x in "xc" for i in range(len(scans))])
