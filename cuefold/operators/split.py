"""Whole-group holdout: groups are ranked by richness and held out until there are enough rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuefold.columns import free
from cuefold.operators.numbering import scanned


def ranked_groups(rows: DataFrame, group: str, rich: Column, pos: str = "pos") -> DataFrame:
    """group, n, rich, fraction, first, rank, before, n_groups, total: one row for each group. Ranks and running sums come from ranges, so there may be as many groups as rows."""
    sums = rows.groupBy(group).agg(F.count("*").alias("n"), F.count_if(rich).alias("rich"), F.min(pos).alias("first"))
    sums = sums.withColumn("fraction", F.col("rich") / F.col("n"))
    order = [F.desc("fraction"), F.desc("rich"), F.desc("n"), F.asc("first")]
    ranked = scanned(sums, [], order, {"rank": ("sum", F.lit(1), True), "before": ("sum", F.col("n"), False)})
    n_groups, total = ranked.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    return ranked.withColumns({"rank": F.col("rank").cast("int"), "before": F.coalesce("before", F.lit(0)), "n_groups": F.lit(n_groups), "total": F.lit(total)})


def held_groups(rows: DataFrame, group: str, rich: Column, share: float = 0.1, pos: str = "pos") -> DataFrame:
    """The groups to hold out: richest first while fewer rows than max(1, round half even(total * share)) are held, never all."""
    target = F.greatest(F.lit(1), F.bround(F.col("total") * F.lit(share)).cast("long"))
    return ranked_groups(rows, group, rich, pos).where((F.col("before") < target) & (F.col("rank") < F.col("n_groups"))).select(group)


def forced_groups(rows: DataFrame, group: str, forced: list[str], short_labels: bool = False) -> DataFrame:
    """The forced groups; one that does not occur raises. With short_labels, EP7 stands for EP7_<id>."""
    spark = rows.sparkSession
    asked = spark.createDataFrame([(g,) for g in forced], "asked string")
    known = rows.select(group).distinct()
    name = F.split(F.col(group), "_")[0] if short_labels else F.col(group)
    found = asked.join(known, (F.col("asked") == F.col(group)) | (F.col("asked") == name), "left")
    missing = [r.asked for r in found.where(F.col(group).isNull()).select("asked").collect()]  # of the caller's list
    if missing:
        raise ValueError(f"groups that don't occur: {missing}")
    return found.select(group).distinct()


def split_rows(rows: DataFrame, held: DataFrame, group: str) -> DataFrame:
    """rows with split: eval for held groups, else train."""
    free(rows, "split", "_held")
    return rows.join(held.withColumn("_held", F.lit(True)), group, "left").withColumn("split", F.when(F.col("_held"), "eval").otherwise("train")).drop("_held")


def bucket_counts(rows: DataFrame, bucket_col: str = "buckets") -> DataFrame:
    """bucket, train, eval: a row counts once in each bucket that it holds."""
    sums = rows.select("split", F.explode(bucket_col).alias("bucket")).groupBy("bucket").pivot("split", ["train", "eval"]).count()
    return sums.na.fill(0, ["train", "eval"])


def split_report(rows: DataFrame) -> DataFrame:
    """train, eval, eval_share."""
    sums = rows.agg(F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "eval").alias("eval"))
    total = F.col("train") + F.col("eval")
    return sums.withColumn("eval_share", F.when(total > 0, F.col("eval") / total))


def leaks(rows: DataFrame, group: str) -> DataFrame:
    """Groups in more than one split; empty where the holdout is sound."""
    return rows.groupBy(group).agg(F.count_distinct("split").alias("splits")).where("splits > 1")
