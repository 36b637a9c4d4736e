"""Mixing sources to target weights by hash-threshold histograms, with DataFrame functions alone.

Sources share BUDGET times all words by weight; a source's target stops at MAX_EPOCHS times its words and
the excess goes to the others by weight. A document's place is a hash of its id, source and size; rows that
share all three are told apart by a hash of their row number, where the budget ends among them. Words are summed by source and bucket of that place. A source takes floor(target /
words) copies of everything, and one copy more of the documents whose place is below a threshold: the
thresholds are nested, as the last copy's lies inside the one before. The bucket in which the remaining
budget ends is refined, level by level, until one document is left in it; that one goes in where this
brings the source nearer to its target. Nothing is sorted but the sums.

Defined results: size is the number of runs of characters other than white space (null: 0); a document
without words is taken once where its place is below the threshold and counts 0; a null source is a source
of its own, last; sources without words have target 0; repeated rows are documents of their own; an empty
table gives an empty one. The table of sources, a sum for each, is the only one that a single task reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuefold.llm.rows import Rows
from cuefold.llm.storage import written

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_EPOCHS = 2
LEVEL_BITS = 10
LEVELS = 6
#: Sources that are broadcast; of more, the ones of most rows are.
MAX_BROADCAST_SOURCES = 200_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source (as a struct, so that null is a value), size, place of every row, written once."""
    return written(_placed(docs.select(*_slim_columns(docs, id_col, text_col, source_col, F.monotonically_increasing_id()))), "sizes")


def _slim_columns(docs: DataFrame, id_col: str, text_col: str, source_col: str, rid: Column) -> list[Column]:
    source = docs[source_col].cast("string")
    return [
        docs[id_col].alias("doc_id"), F.struct(source.isNull().alias("missing"), F.coalesce(source, F.lit("")).alias("name")).alias("source"),
        words(docs[text_col]).alias("size"), rid.alias("rid"),
    ]


def _placed(slim: DataFrame) -> DataFrame:
    """place: upper and lower part, LEVELS * LEVEL_BITS bits each."""
    part = lambda *cols: F.shiftrightunsigned(F.xxhash64(*cols), 64 - LEVELS * LEVEL_BITS)
    return slim.withColumn("place", F.struct(part("doc_id", "source", "size").alias("upper"), part("rid").alias("lower")))


def targets(by_source: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target. Shares that end at most times a source's words, found by water level.

    In ascending order of words / weight, sources fill up; with those before k full, the level is
    (budget - their caps) / the weights from k on. The first level that does not fill source k holds for it
    and for all after it.
    """
    rank = F.row_number().over(Window.orderBy("source")) - 1  # one row for each source
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    shared = by_source.select("source", "source_size", weight.alias("weight"), (F.sum("source_size").over(Window.partitionBy()) * F.lit(budget)).alias("budget"))
    cap = F.col("source_size") * F.lit(float(most))
    shared = shared.withColumn("cap", cap).withColumn("fills_at", F.col("cap") / F.col("weight"))
    order = Window.orderBy("fills_at", "source")
    full = F.sum("cap").over(order) - F.col("cap")
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.col("budget") - full) / rest
    leveled = shared.withColumn("level", level)
    # levels that leave their source unfilled fall from the first on, which is the one that holds
    stop = F.max(F.when(F.col("level") < F.col("fills_at"), F.col("level"))).over(Window.partitionBy())
    target = F.when(stop.isNull() | (F.col("fills_at") <= stop), F.col("cap")).otherwise(stop * F.col("weight"))
    return leveled.select("source", "source_size", target.alias("target"))


def _bits(level: int, down: bool = False) -> Column:
    """The place's bits at `level`, or from the start of its part down to it."""
    part = F.col("place.upper" if level < LEVELS else "place.lower")
    bits = F.shiftright(part, LEVEL_BITS * (LEVELS - 1 - level % LEVELS))
    return bits if down else bits.bitwiseAND(F.lit((1 << LEVEL_BITS) - 1))


def _of_sources(rows: DataFrame, table: DataFrame, hot: DataFrame | None) -> DataFrame:
    """rows joined to the row of `table` for their source: a broadcast where `hot` is None (there are MAX_BROADCAST_SOURCES
    at most). Else the sources of `hot`, the ones of most rows, are broadcast, and the others shuffle, none of which is large."""
    if hot is None:
        return rows.join(F.broadcast(table), "source")
    known = F.broadcast(hot)
    small = rows.join(known, "source", "left_anti").join(table, "source")
    return rows.join(F.broadcast(table.join(known, "source", "left_semi")), "source").unionByName(small)


def thresholds(slim: DataFrame, plan: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """source, copies, edge, edge_level, last: `copies` of everything, one more where the place is below `edge`
    (upper and lower part, compared down to edge_level), and with `last` of the one document at the edge."""
    left = F.greatest(F.col("target") - F.col("copies") * F.col("source_size"), F.lit(0.0))
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    nothing = F.lit(0).cast("long")
    open_ = plan.withColumn("copies", copies).withColumn("left", left).withColumns({"upper": nothing, "lower": nothing})
    open_ = written(open_, "mix")
    done = None
    for level in range(2 * LEVELS):
        rows = _of_sources(slim.select("source", "size", "place"), open_.select("source", "left", "upper", "lower"), hot)
        if level:
            rows = rows.where(_bits(level - 1, True) == F.col("upper" if level <= LEVELS else "lower"))
        if level > LEVELS:
            rows = rows.where(F.col("place.upper") == F.col("upper"))
        sums = rows.groupBy("source", "left", _bits(level).alias("bucket")).agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        order = Window.partitionBy("source").orderBy("bucket")  # 2 ** LEVEL_BITS rows at most
        # the first bucket that the budget does not wholly cover
        over = sums.withColumn("before", F.sum("words").over(order) - F.col("words")).where(F.col("before") + F.col("words") > F.col("left"))
        found = over.withColumn("k", F.row_number().over(order)).where("k = 1").select("source", "bucket", "before", "words", "n")
        part = "upper" if level < LEVELS else "lower"
        next_ = open_.join(found, "source", "left").select(
            *[c for c in ("source", "source_size", "target", "copies", "upper", "lower") if c != part],
            # without such a bucket all of the stretch is taken: the edge lies behind it
            (F.col(part) * (1 << LEVEL_BITS) + F.coalesce("bucket", F.lit(1 << LEVEL_BITS))).alias(part),
            (F.col("left") - F.coalesce("before", F.lit(0))).alias("left"), F.coalesce("words", F.lit(0)).alias("words"), F.coalesce("n", F.lit(0)).alias("n"),
        )
        next_ = written(next_, "mix")
        final = F.lit(True) if level == 2 * LEVELS - 1 else F.col("n") <= 1
        last = F.col("words") < 2 * F.col("left")  # nearer to the target with the document at the edge than without
        ended = next_.where(final).select("source", "source_size", "target", "copies", "upper", "lower", F.lit(level).alias("edge_level"), last.alias("last"))
        done = ended if done is None else done.unionByName(ended)
        open_ = next_.where(~final).select("source", "source_size", "target", "copies", "upper", "lower", "left")
        if open_.isEmpty():
            break
    return done


def _taken(slim: DataFrame, mixed: tuple[DataFrame, DataFrame | None], most: int) -> DataFrame:
    """slim with its source's edge and copies: how often the mix takes the row."""
    rows = _of_sources(slim, *mixed)
    here = lambda level: F.coalesce(*[F.when(F.col("edge_level") == k, _bits(k, True)) for k in level])
    upper = F.coalesce(here(range(LEVELS)), F.col("place.upper"))
    lower = F.coalesce(here(range(LEVELS, 2 * LEVELS)), F.lit(0))
    at = (upper == F.col("upper")) & (lower == F.col("lower"))
    below = (upper < F.col("upper")) | ((upper == F.col("upper")) & (lower < F.col("lower")))
    copies = F.least(F.lit(most), F.col("copies") + (below | (at & F.col("last"))).cast("long"))
    return rows.withColumn("copies", copies)


def _edges(slim: DataFrame, weights, budget: float, most: int) -> tuple[DataFrame, DataFrame | None]:
    """The edges of all sources, and the sources of most rows where there are too many to be broadcast."""
    sums = written(slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "sources")
    many = sums.count() > MAX_BROADCAST_SOURCES
    hot = written(sums.orderBy(F.desc("n"), "source").limit(MAX_BROADCAST_SOURCES).select("source"), "hot") if many else None
    plan = targets(sums.drop("n"), weights, budget, most)
    return written(thresholds(slim, written(plan, "targets"), hot), "edges"), hot


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, budget: float = BUDGET, most: int = MAX_EPOCHS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken."""
    slim = sizes(docs, id_col, text_col, source_col)
    rows = _taken(slim, _edges(slim, weights, budget, most), most)
    return rows.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(
    docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, budget: float = BUDGET, most: int = MAX_EPOCHS
) -> DataFrame:
    """The rows that the mix takes, all columns, as often as it takes them. No row is shuffled.

    Rows of one id, source and size are told apart by their place in the files, which both readings share."""
    read = Rows(docs)
    columns = _slim_columns(read.docs, id_col, text_col, source_col, F.xxhash64(*read.place()))
    slim = written(_placed(read.docs.select(*columns)), "sizes")
    rows = _taken(_placed(read.docs.select(F.struct("*").alias("doc"), *columns)), _edges(slim, weights, budget, most), most)
    return rows.where("copies > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")
