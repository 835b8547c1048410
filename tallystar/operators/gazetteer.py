"""Names of a gazetteer found in labels, by a trie of words.

Rules that test a label against each of ten names one by one do not carry over to a list
of thousands.  Here the list becomes a table of its prefixes, cut at words: the nodes of a
trie.  Each word of a label is a place where a name may start; places walk down the trie
by one join per depth, and those that leave it are dropped or stop matching.  The number
of joins is that of the longest name's words, however many names and labels there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.functions.scalars import ColumnOrName, col

WORD = r"[\p{L}\p{N}]+"
#: A name of more words than this is refused: each depth is a join of the plan.
MOST_WORDS = 16


def words_of(label: ColumnOrName) -> Column:
    """Runs of letters and digits, in order; null without a label."""
    return F.regexp_extract_all(col(label), F.lit(f"({WORD})"), F.lit(1))


def _prefix(words: Column, length: Column | int) -> Column:
    return F.array_join(F.slice(words, 1, length), " ")


def name_trie(gazetteer: DataFrame, name: str, order: str) -> tuple[DataFrame, int]:
    """``(node, name, name_order)`` of every prefix of every name, and the greatest depth.

    A node that ends a name carries it, and others null.  Of names with the same words
    the first by order, then by text, stands.  Names without a word or null are left out.
    """
    cut = gazetteer.select(
        F.col(name).alias("name"), F.col(order).alias("name_order"), words_of(name).alias("words")
    ).filter(F.size("words") > 0)
    depth = cut.agg(F.max(F.size("words"))).first()[0] or 0
    if depth > MOST_WORDS:
        raise ValueError(f"a name of {depth} words; at most {MOST_WORDS} are searched for")
    length = F.explode(F.sequence(F.lit(1), F.size("words"))).alias("length")
    prefixes = cut.select("name", "name_order", "words", length)
    ends = F.col("length") == F.size("words")
    named = F.min(F.when(ends, F.struct("name_order", "name")))
    nodes = prefixes.groupBy(_prefix(F.col("words"), F.col("length")).alias("node")).agg(
        named.alias("_end"))
    return nodes.select("node", F.col("_end.name").alias("name"),
                        F.col("_end.name_order").alias("name_order")), depth


def mentions(
    labels: DataFrame, label: str, gazetteer: DataFrame, name: str, order: str
) -> DataFrame:
    """``(label, start, n_words, name, name_order)``: the longest name from each word on.

    Labels are taken once each.  ``start`` counts words from 0.  Names match whole words,
    with any punctuation between them, and case counts.  Null labels mention nothing.
    """
    nodes, depth = name_trie(gazetteer, name, order)
    cut = labels.select(F.col(label).alias("label")).filter("label IS NOT NULL").distinct()
    cut = cut.withColumn("words", words_of("label"))
    walking = cut.select("label", F.posexplode("words").alias("start", "_first"), "words").select(
        "label", "start", F.expr(f"slice(words, start + 1, {max(depth, 1)})").alias("ahead"))
    walking = walking.withColumns({
        "n_words": F.lit(None).cast("int"), "name": F.lit(None).cast("string"),
        "name_order": F.lit(None).cast(gazetteer.schema[order].dataType),
        "_alive": F.lit(True),
    })
    for level in range(1, depth + 1):
        step = nodes.select(
            F.col("node").alias("_node"), F.col("name").alias("_name"),
            F.col("name_order").alias("_order"))
        on_way = F.col("_alive") & (F.size("ahead") >= level)
        # Places that have left the trie keep a key of their own, which no node has, so
        # that they do not gather in one task.
        off = F.concat(F.lit("\x00"), F.xxhash64("label", "start").cast("string"))
        keyed = walking.withColumn("_key", F.when(on_way, _prefix(F.col("ahead"), level)).otherwise(off))
        met = keyed.join(step, F.col("_key") == F.col("_node"), "inner" if level == 1 else "left")
        ended = F.col("_name").isNotNull()
        walking = met.select(
            "label", "start", "ahead",
            F.when(ended, F.lit(level)).otherwise(F.col("n_words")).alias("n_words"),
            F.when(ended, F.col("_name")).otherwise(F.col("name")).alias("name"),
            F.when(ended, F.col("_order")).otherwise(F.col("name_order")).alias("name_order"),
            F.col("_node").isNotNull().alias("_alive"),
        )
    return walking.filter("name IS NOT NULL").drop("ahead", "_alive")


def named_in(
    labels: DataFrame, label: str, gazetteer: DataFrame, name: str, order: str,
    prefer: str = "longest",
) -> DataFrame:
    """``(label, name, mentions)``: one row per label, null included, with the name it means.

    ``prefer="longest"`` takes the mention of most words, then the first of the list, then
    the first in the label.  ``"listed"`` takes the first of the list that is mentioned
    anywhere, as rules tested in order do.  Without a mention the name is null.
    """
    if prefer not in ("longest", "listed"):
        raise ValueError(f"prefer must be 'longest' or 'listed', not {prefer!r}")
    found = mentions(labels, label, gazetteer, name, order)
    rank = [-F.col("n_words"), F.col("name_order"), F.col("start")]
    if prefer == "listed":
        rank = [F.col("name_order"), F.col("start")]
    best = found.groupBy("label").agg(
        F.min_by("name", F.struct(*rank)).alias("name"), F.count(F.lit(1)).alias("mentions"))
    every = labels.select(F.col(label).alias("label")).distinct()
    return every.join(best, "label", "left").select(
        "label", "name", F.coalesce("mentions", F.lit(0)).alias("mentions"))
