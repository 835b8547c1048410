"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, the source's target
over its size.  The copies are laid on a line, shortest documents first, shifted by one
random offset per source, and a document is taken once for each whole number that its
piece of the line crosses.  Because the line is ordered by size, the words taken differ
from the target by about one long document, whatever the spread of sizes.

No task sees a whole source: positions on the line come from counts per cell (source,
size, remainder of the id), so a source or a group of copies that holds a third of all
rows is spread over cells, and the counts are summed up along a distributed sort of the
cells, so that the cells of one source are spread as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.llm.common import join_ids, space_words, stored, unit_fraction, unused

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
TIE_CELLS = 64
SEED = "mix-1:"
#: Up to so many sources, a few ten bytes each, are broadcast to the rows; more are joined.
BROADCAST_SOURCES = 100_000


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit("null"))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_copies: int = MAX_COPIES
) -> DataFrame:
    """Target of each source: (source_key, source, source_size, target).

    ``sizes`` has one row per source.  Sources by code point, null last, take the weights
    in turn.  A target stops at ``max_copies`` times its source; what is over goes to the
    others by weight.  With sources ordered by cap over weight, the capped ones are a
    prefix, so one pass of running sums finds the level at which no one is above.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    everything = Window.partitionBy()
    weighed = (
        sizes.withColumn("position", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(cycle, ((F.col("position") - 1) % len(weights) + 1)))
        .withColumn("cap", F.col("source_size") * F.lit(max_copies))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
    )
    line = Window.orderBy("ratio", "position")
    before = F.coalesce(F.sum("cap").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(line.rowsBetween(0, Window.unboundedFollowing))
    levels = weighed.withColumn("level", (F.col("total") - before) / rest)
    fits = F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "position", "level"))
    return levels.withColumn("at", F.min(fits).over(everything)["level"]).select(
        "source_key", "source", "source_size",
        F.coalesce(
            F.least(F.col("cap").cast("double"), F.col("at") * F.col("weight")),
            F.col("cap").cast("double"),
        ).alias("target"),
    )


_SLOT_BITS = 33  # monotonically_increasing_id keeps the partition number above bit 33


def _along_line(cells: DataFrame) -> DataFrame:
    """``cells`` with ``before``: rows in all cells ahead, by source, size and remainder.

    A distributed sort gives each cell a slot; sums run within a partition of the sort, and
    one row per partition carries them on to the next.
    """
    slotted = stored(cells.orderBy("source_key", "size", "cell").withColumn(
        "slot", F.monotonically_increasing_id()).withColumn("part", F.shiftright("slot", _SLOT_BITS)))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = slotted.groupBy("part").agg(F.sum("n").alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("carried"))
    within = Window.partitionBy("part").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return (
        slotted.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(F.broadcast(parts), "part")
        .withColumn("before", F.col("carried") + F.col("inside"))
        .drop("slot", "part", "inside", "carried")
    )


def mix_plan(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    tie_cells: int = TIE_CELLS,
) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies, taken.

    A null or blank text has size 0 and takes 0 words.  A null source is a source of its
    own, ordered last.  Repeated rows are rows like any other.  Null ids are ordered
    first and share a cell.  An empty table gives an empty plan.  Reruns agree: the
    offset depends on the source only, ties are settled by id.
    """
    sized = stored(docs.select(
        F.col("doc_id"), F.col("source"), _source_key(F.col("source")).alias("source_key"),
        F.size(space_words(F.col("text"))).cast("long").alias("size"),
        F.pmod(F.coalesce(F.col("doc_id"), F.lit(0)), F.lit(tie_cells)).alias("cell"),
    ))
    place = ["source_key", "size", "cell"]
    cells = _along_line(
        sized.groupBy(*place).agg(F.count("*").alias("n"), F.first("source").alias("source")))
    sizes = stored(cells.groupBy("source_key").agg(
        F.first("source").alias("source"), F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.min("before").alias("line_start")))
    starts = cells.select(*place, "before")
    in_cell = F.row_number().over(Window.partitionBy(*place).orderBy("doc_id"))
    ranked = (
        sized.repartition(*place).withColumn("in_cell", in_cell)
        .join(starts, place)
    )
    targets = source_targets(sizes, weights, max_copies).drop("source").join(
        sizes.select("source_key", "line_start"), "source_key")
    if sizes.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    position = F.col("before") - F.col("line_start") + F.col("in_cell")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = unit_fraction(F.col("source"), SEED)
    crossed = (
        F.floor(F.col("position") * F.col("rate") + offset)
        - F.floor((F.col("position") - 1) * F.col("rate") + offset)
    )
    return (
        ranked.join(targets, "source_key")
        .withColumn("position", position)
        .withColumn("rate", rate)
        .withColumn("copies", F.least(crossed, F.lit(max_copies)).cast("long"))
        .select(
            "doc_id", "source", "size", "source_size", "target", "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
        )
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Copies are decided per row.  Rows that repeat an id pool their copies: as many rows
    leave as were taken, spread over them.
    """
    plan = mix_plan(docs, **options)
    mix_copies, mix_rows, mix_take, mix_copy = (
        unused(c, docs) for c in ("mix_copies", "mix_rows", "mix_take", "mix_copy"))
    copies = plan.groupBy("doc_id").agg(
        F.sum("copies").alias(mix_copies), F.count("*").alias(mix_rows))
    copies = stored(copies.where(F.col(mix_copies) > 0))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    once = join_ids(docs, copies.where(F.col(mix_rows) == 1).drop(mix_rows), "inner").withColumn(
        mix_take, F.col(mix_copies))
    twins = stored(copies.where(F.col(mix_rows) > 1))
    if not twins.isEmpty():
        # A row of an id that repeats cannot be told from its twins: each gives the mean,
        # and the first by content give what is left over.
        again = join_ids(docs, twins, "inner")
        place = F.row_number().over(Window.partitionBy("doc_id").orderBy(*columns))
        share = F.floor(F.col(mix_copies) / F.col(mix_rows))
        over = F.when(place <= F.col(mix_copies) % F.col(mix_rows), 1).otherwise(0)
        again = again.withColumn(mix_take, share + over).drop(mix_rows).where(F.col(mix_take) > 0)
        once = once.unionByName(again)
    return once.withColumn(
        mix_copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(mix_take).cast("long")))
    ).select(*columns)
