"""How far the sources of a language are from each other, term by term.

Every (language, source) group keeps its counts of the language's terms as sorted arrays
of (term id, count), cut into blocks of ids.  The arrays of a language's groups meet block by
block, and every unordered pair of them is merged by a galloping intersection, which
prices terms that both have and terms that one has, both ways.  Terms that neither has
all cost the same and are priced by their number.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.llm.common import small_batches, stored

#: Fixed values of the contract: documents a kept term is in, parts of a share, ranks of terms.
DOCUMENTS = 3
UNIT = 1_000_000_000
TERM_RANKS = 200
#: Term ids per block: what a task of a pair holds of each side.
BLOCK = 1 << 12
#: Bits of a packed (term id in its block, count) that are the count's.
COUNT_BITS = 48
#: Sources whose arrays are in one task; more of a language are taken chunk by chunk.
CHUNK = 32
#: Distinct terms a task holds before it hands its counts on.
HELD_TERMS = 200_000

# Bytes that belong to a term: letters, and everything beyond ASCII.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


# Counts --------------------------------------------------------------------------


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a task, handed on whenever enough terms are held."""
    held: dict[tuple[str, str], dict[bytes, list[int]]] = defaultdict(dict)
    n = 0

    def out() -> pa.RecordBatch:
        rows = [(g[0], g[1], term, c, d) for g, terms in held.items() for term, (c, d) in terms.items()]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()),
             pa.array(columns[2], pa.binary()).cast(pa.string()), pa.array(columns[3], pa.int64()),
             pa.array(columns[4], pa.int64())],
            names=["lang", "source", "term", "count", "docs"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("lang", "source")]
        for lang, source, text in zip(*columns, batch.column("text").cast(pa.binary()), strict=True):
            terms = held[lang, source]
            found: dict[bytes, int] = {}
            for term in text.as_py().translate(_FOLD).split(b" "):
                if term:
                    found[term] = found.get(term, 0) + 1
            before = len(terms)
            for term, times in found.items():
                entry = terms.get(term)
                if entry is None:
                    terms[term] = [times, 1]
                else:
                    entry[0] += times
                    entry[1] += 1
            n += len(terms) - before
            if n >= HELD_TERMS:
                yield out()
                held.clear()
                n = 0
    yield out()


def _plain(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")).alias(name)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, count, docs): occurrences of each term, and rows that hold it.

    Tasks have counted already; what they send is dealt by language and term, so that
    counts per group and per language need no further shuffle.
    """
    texts = small_batches(docs).select(_plain("lang"), _plain("source"), _plain("text"))
    partial = texts.mapInArrow(_counts, "lang string, source string, term string, count long, docs long")
    return partial.repartition("lang", "term").groupBy("lang", "source", "term").agg(
        F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def numbered_terms(counts: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """(lang, term, total, uses, id): kept terms, numbered from 0 within their language.

    ``uses`` has (source, count) of each of the language's sources with the term.  A task
    numbers its own terms; ids follow from the number of terms before each task's, one
    row per task and language.
    """
    slotted = stored(
        counts.groupBy("lang", "term").agg(
            F.sum("docs").alias("docs"), F.sum("count").alias("total"),
            F.collect_list(F.struct("source", "count")).alias("uses"))
        .where(F.col("docs") >= documents).select("lang", "term", "total", "uses")
        .sortWithinPartitions("lang").withColumn("slot", F.monotonically_increasing_id()))
    task = F.shiftright("slot", 33)
    before = Window.partitionBy("lang").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = slotted.groupBy("lang", task.alias("task")).agg(
        F.count("*").alias("n"), F.min("slot").alias("least")).select(
        "lang", "task", "least", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return slotted.withColumn("task", task).join(starts, ["lang", "task"]).select(
        "lang", "term", "total", "uses", (F.col("before") + F.col("slot") - F.col("least")).alias("id"))


# Shares --------------------------------------------------------------------------


def share(count: Column, whole: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / whole), by long division so that no step overflows."""
    left = count + 1
    digits = F.call_function("div", left, whole)
    left = left % whole
    for _ in range(3):
        digits = digits * 1000 + F.call_function("div", left * 1000, whole)
        left = left * 1000 % whole
    return digits + 1


def shares(counts: np.ndarray, whole: int) -> np.ndarray:
    """The same for an array of counts."""
    left = counts.astype(np.int64) + 1
    digits = left // whole
    left = left % whole
    for _ in range(3):
        digits = digits * 1000 + left * 1000 // whole
        left = left * 1000 % whole
    return digits + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q) for each term; shares are at most UNIT + 1, so squares fit."""
    gap = p - q
    return gap * gap // q


# Pairs ---------------------------------------------------------------------------


def gallop(few: np.ndarray, many: np.ndarray, run: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Places in both of the ids that two sorted arrays share.

    The shorter array is taken run by run.  From where the last run ended, doubling steps
    through the longer one bracket the run, and only the bracket is searched.
    """
    low, in_few, in_many = 0, [], []
    for start in range(0, len(few), run):
        part = few[start : start + run]
        high, step = low, 1
        while high < len(many) and many[high] < part[-1]:
            high, step = high + step, 2 * step
        bracket = many[low : high + 1]
        spot = np.searchsorted(bracket, part)
        inside = np.flatnonzero(spot < len(bracket))
        met = inside[bracket[spot[inside]] == part[inside]]
        in_few.append(met + start)
        in_many.append(spot[met] + low)
        low += int(spot[-1])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *in_few]), np.concatenate([none, *in_many])


def price(
    ids_a: np.ndarray, counts_a: np.ndarray, whole_a: int,
    ids_b: np.ndarray, counts_b: np.ndarray, whole_b: int,
) -> tuple[int, int, int]:
    """Sums of f over the terms that a or b has: a against b, b against a; and their number."""
    swap = len(ids_a) > len(ids_b)
    in_few, in_many = gallop(*((ids_b, ids_a) if swap else (ids_a, ids_b)))
    in_a, in_b = (in_many, in_few) if swap else (in_few, in_many)
    p_a, p_b = shares(counts_a, whole_a), shares(counts_b, whole_b)
    none_a, none_b = (shares(np.zeros(1, dtype=np.int64), w) for w in (whole_a, whole_b))
    only_a, only_b = np.delete(p_a, in_a), np.delete(p_b, in_b)
    there = sum(int(divergence(p, q).sum()) for p, q in (
        (p_a[in_a], p_b[in_b]), (only_a, none_b), (none_a, only_b)))
    back = sum(int(divergence(p, q).sum()) for p, q in (
        (p_b[in_b], p_a[in_a]), (none_b, only_a), (only_b, none_a)))
    return there, back, len(ids_a) + len(ids_b) - len(in_a)


_PRICED = "lang string, a string, b string, there long, back long, met long"


def _pair_tasks(key: tuple, table: pa.Table) -> pa.Table:
    """Every pair of two chunks of a language's sources, or of one, in one block."""
    lang, _, first, second = (k.as_py() for k in key)
    packed = table.column("terms").combine_chunks()
    flat = np.asarray(packed.flatten(), dtype=np.int64)
    ends = np.cumsum(np.asarray(packed.value_lengths().fill_null(0), dtype=np.int64))
    names, wholes, chunks = (table.column(c).to_pylist() for c in ("source", "whole", "chunk"))
    groups = sorted((
        (chunk, name.encode(), name, whole, part)
        for chunk, name, whole, part in zip(chunks, names, wholes, np.split(flat, ends[:-1]), strict=True)),
        key=lambda group: group[:2])
    sides = [(c, n, w, part >> COUNT_BITS, part & (1 << COUNT_BITS) - 1) for c, _, n, w, part in groups]
    rows = []
    for k, (chunk, a, whole_a, *terms_a) in enumerate(sides):
        for its, b, whole_b, *terms_b in sides[k + 1 :]:
            if (chunk, its) == (first, second):
                rows.append((lang, a, b, *price(*terms_a, whole_a, *terms_b, whole_b)))
    columns = zip(*rows, strict=True) if rows else [()] * 6
    types = [pa.string()] * 3 + [pa.int64()] * 3
    return pa.table(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
        names=["lang", "a", "b", "there", "back", "met"])


def _pair_values(terms: DataFrame, groups: DataFrame, block: int, chunk: int) -> DataFrame:
    """(lang, source, item, value) for both directions of every pair of a language.

    An array meets those of its own chunk of sources and of every other chunk, once per
    chunk and not once per source.  Every source has an array in every block of its
    language, be it empty, so that terms only one side has are priced too.
    """
    ranked = groups.withColumn("place", F.row_number().over(
        Window.partitionBy("lang").orderBy("source")) - 1).select(
        "lang", "source", "whole", "kept_terms", F.expr(f"place div {chunk}").alias("chunk"))
    others = ranked.groupBy("lang").agg(F.max("chunk").alias("last"))
    ranked = stored(ranked.join(others, "lang"))
    uses = terms.select("lang", F.expr(f"id div {block}").alias("block"), (
        F.col("id") % block).alias("at"), F.inline("uses"))
    arrays = uses.groupBy("lang", "source", "block").agg(F.sort_array(F.collect_list(
        F.shiftleft("at", COUNT_BITS).bitwiseOR(F.col("count")))).alias("terms"))
    last_block = F.expr(f"(kept_terms - 1) div {block}")
    slots = ranked.where("kept_terms > 0").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), last_block)))
    dealt = slots.join(arrays, ["lang", "source", "block"], "left").withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
    priced = dealt.select(
        "lang", "block", F.least("chunk", "other").alias("first"),
        F.greatest("chunk", "other").alias("second"), "source", "whole", "chunk", "terms",
    ).groupBy("lang", "block", "first", "second").applyInArrow(_pair_tasks, _PRICED)
    left, right = (ranked.select(
        "lang", F.col("source").alias(n), F.col("whole").alias(f"whole_{n}"), F.col("kept_terms").alias(f"kept_{n}"),
        F.col("chunk").alias(f"chunk_{n}")) for n in "ab")
    pairs = left.join(right, "lang").where("a < b").withColumn("kept_terms", F.col("kept_a"))
    sums = priced.groupBy("lang", "a", "b").agg(
        *[F.sum(c).alias(c) for c in ("there", "back", "met")])
    none = F.lit(0).cast("long")
    p_a, p_b = share(none, F.col("whole_a")), share(none, F.col("whole_b"))

    def value(sum_of: str, p: Column, q: Column) -> Column:
        absent = F.col("kept_terms") - F.coalesce("met", none)
        return F.coalesce(sum_of, none) + absent * F.call_function("div", (p - q) * (p - q), q)

    whole = pairs.join(sums, ["lang", "a", "b"], "left").select(
        "lang", F.inline(F.array(
            F.struct(F.col("a").alias("source"), F.col("b").alias("item"), value("there", p_a, p_b).alias("value")),
            F.struct(F.col("b").alias("source"), F.col("a").alias("item"), value("back", p_b, p_a).alias("value")))))
    return whole.select("lang", "source", "item", "value")


def _term_values(placed: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): terms a group uses more than its language does."""
    p, q = share(F.col("count"), F.col("whole")), share(F.col("total"), F.col("lang_whole"))
    both = placed.join(groups.select("lang", "source", "whole", "lang_whole"), ["lang", "source"])
    priced = both.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
    gap = F.col("p") - F.col("q")
    return priced.where("p > q").select(
        "lang", "source", "item", F.call_function("div", gap * gap, F.col("q")).alias("value"))


def audit(
    docs: DataFrame, documents: int = DOCUMENTS, term_ranks: int = TERM_RANKS, block: int = BLOCK,
    chunk: int = CHUNK,
) -> DataFrame:
    """(lang, source, part, item, value, rank): sources against each other, and their terms.

    A null text, language or source is read as empty; empty names are a language or a
    source like any other.  Every row is a document, also where an id repeats or is null;
    other columns are not read.  A group without terms takes part with a count of zero
    for every term; a language with no kept term gives its pairs the value 0; a single
    source has no pairs.  Equal values are ranked by the bytes of their names.  An empty
    table gives an empty result.
    """
    terms = numbered_terms(term_counts(docs), documents)
    placed = terms.select("lang", "term", "total", F.inline("uses"))
    languages = terms.groupBy("lang").agg(
        F.count("*").alias("kept_terms"), F.sum("total").alias("lang_n"))
    sizes = placed.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    none = F.lit(0).cast("long")
    kept = F.coalesce("kept_terms", none)
    groups = stored(
        docs.select(_plain("lang"), _plain("source")).distinct()
        .join(sizes, ["lang", "source"], "left").join(languages, "lang", "left")
        .select(
            "lang", "source", kept.alias("kept_terms"),
            F.greatest(F.coalesce("n", none) + kept, F.lit(1)).alias("whole"),
            F.greatest(F.coalesce("lang_n", none) + kept, F.lit(1)).alias("lang_whole")))
    along = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(along).alias("rank")
    pairs = _pair_values(terms, groups, block, chunk).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", rank)
    found = _term_values(placed, groups).select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", rank)
    return pairs.union(found.where(F.col("rank") <= term_ranks))
