"""Near-duplicates by SimHash, found through a byte-position inverted index.

A fingerprint has eight bytes.  Two fingerprints that differ in at most two bits differ
in at most two bytes, so they share at least six positional bytes: that is the count a
pair must reach.  Posting lists of single bytes would hold 1/256 of the corpus each, so
the index keys every fingerprint by each choice of six positions with their values: a
pair stands in a common list exactly when its tally of shared positional bytes reaches
six, and no pair below the count is ever formed.  Pairs from a list are verified by the
bits they differ in.

A list holds at most 2^16 fingerprints, its two free bytes.  Long lists are not paired
off: each fingerprint is keyed again by its free bytes with every choice of two bits
blanked out, and those that agree, four at most, are linked to the smallest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import one_of_each_group, row_mark, small_batches, stored
from tallystar.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
PAIRED_LIST = 64
BYTES = 8
#: Bytes of a text whose words are held at once.
PIECE = 1 << 18
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about ``PIECE`` bytes, cut at white space."""
    start = 0
    while start < len(text):
        cut = _SPACE.search(text, start + PIECE)
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def _ones(words: list[bytes], size: int) -> tuple[np.ndarray, int]:
    """How often each bit is set in the hashes of all runs of ``size`` words, and their number."""
    joined = memoryview(b" ".join(words))
    digest = xxhash.xxh64_intdigest
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=">u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, BYTES), axis=1)
    return bits.sum(axis=0, dtype=np.int64), len(hashes)


def fingerprint(text: bytes, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a text, as a signed integer; no word gives zero.

    Words are cut piece by piece, so that a long text needs little more than itself.
    """
    ones, shingles, words = np.zeros(64, dtype=np.int64), 0, []
    for piece in _pieces(text):
        words += piece.lower().split()
        if len(words) >= words_per_shingle:
            found, n = _ones(words, words_per_shingle)
            ones, shingles = ones + found, shingles + n
            # The last words start shingles that end in the next piece.
            words = words[len(words) - words_per_shingle + 1 :]
    if not shingles:
        if not words:
            return 0
        ones, shingles = _ones(words, len(words))
    return int(np.packbits(2 * ones > shingles).view(">i8")[0])


def _fingerprints(words_per_shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            prints = [fingerprint(t.as_py(), words_per_shingle) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(prints, pa.int64())],
                names=["doc_id", "mark", "print"])

    return run


def fingerprints(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, mark, print) for every row; a null text is empty, ``mark`` is ``row_mark``'s."""
    texts = small_batches(docs).select(
        "doc_id", row_mark(F.col("text")).alias("mark"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(
        _fingerprints(words_per_shingle), "doc_id long, mark long, print long")


def _byte_mask(positions: tuple[int, ...]) -> int:
    mask = sum(0xFF << (8 * p) for p in positions)
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _shared_bytes(a: Column, b: Column) -> Column:
    """Tally of positional bytes that two fingerprints share."""
    differing = a.bitwiseXOR(b)
    return sum(
        F.when(differing.bitwiseAND(F.lit(_byte_mask((p,)))) == 0, 1).otherwise(0)
        for p in range(BYTES))


def postings(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Inverted index: (free, key, print), one row per choice of ``max_bits`` free bytes."""
    choices = list(combinations(range(BYTES), max_bits))
    entries = F.array(*[
        F.struct(
            F.lit(number).alias("free"),
            F.col("print").bitwiseAND(F.lit(~_byte_mask(free))).alias("key"))
        for number, free in enumerate(choices)])
    return prints.select("print", F.inline(entries)).select("free", "key", "print")


def print_links(
    prints: DataFrame, max_bits: int = MAX_BITS, paired_list: int = PAIRED_LIST
) -> DataFrame:
    """Edges (a, b) between distinct fingerprints, enough to connect all within ``max_bits``.

    ``prints`` has distinct fingerprints.  Every edge is a verified pair.
    """
    lists = (
        postings(prints, max_bits).groupBy("free", "key")
        .agg(F.collect_list("print").alias("prints")).where(F.size("prints") > 1))
    lists = stored(lists)
    minimum = BYTES - max_bits
    pairs = (
        lists.where(F.size("prints") <= paired_list)
        .select("prints", F.explode("prints").alias("a"))
        .select("a", F.explode(F.filter("prints", lambda p: p > F.col("a"))).alias("b"))
        .where(_shared_bytes(F.col("a"), F.col("b")) >= minimum)
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        .distinct())
    # Long lists: blank out every choice of bits of the free bytes.
    choices = list(combinations(range(BYTES), max_bits))
    blanks = []
    for free in choices:
        bits = [8 * p + k for p in free for k in range(8)]
        masks = [~sum(1 << b for b in chosen) for chosen in combinations(bits, max_bits)]
        blanks.append([m + (1 << 64) if m < -(1 << 63) else m for m in masks])
    table = F.array(*[F.array(*[F.lit(m) for m in row]) for row in blanks])
    keyed = (
        lists.where(F.size("prints") > paired_list)
        .select("free", F.explode("prints").alias("print"))
        .select("print", F.explode(F.element_at(table, F.col("free") + 1)).alias("mask"))
        .select("print", "mask", F.col("print").bitwiseAND(F.col("mask")).alias("rest")))
    stars = (
        keyed.groupBy("mask", "rest").agg(F.collect_set("print").alias("same"))
        .where(F.size("same") > 1)
        .select(F.array_min("same").alias("a"), F.explode("same").alias("b"))
        .where("a <> b").distinct())
    return pairs.union(stars)


def _roots(
    prints: DataFrame, max_bits: int = MAX_BITS, paired_list: int = PAIRED_LIST
) -> DataFrame:
    """(print, head, root): distinct fingerprints, their smallest id, and their component."""
    heads = stored(prints.groupBy("print").agg(F.min("doc_id").alias("head")))
    links = print_links(heads.select("print"), max_bits, paired_list)
    members = connected_components(links).select(
        F.col("node").alias("print"), F.col("component").alias("root"))
    return heads.join(members, "print", "left").withColumn("root", F.coalesce("root", "print"))


def near_duplicates(
    docs: DataFrame,
    words_per_shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    paired_list: int = PAIRED_LIST,
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    Texts without a word, null ones too, share fingerprint zero and link like any other.
    Rows with the same fingerprint collapse to one before anything is compared, so a
    group of copies costs one posting per position choice, whatever its size.  A null id
    takes part and is the component's id only if no other is there.  Repeated rows repeat
    in the result; an empty table gives an empty one.
    """
    prints = stored(fingerprints(docs, words_per_shingle).select("doc_id", "print"))
    rooted = _roots(prints, max_bits, paired_list)
    smallest = rooted.groupBy("root").agg(F.min("head").alias("component_id"))
    answer = rooted.join(smallest, "root").select("print", "component_id")
    return prints.join(answer, "print").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def deduplicated(
    docs: DataFrame,
    words_per_shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    paired_list: int = PAIRED_LIST,
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that of the smallest id.

    Rows are kept or removed by id and text together.
    """
    prints = stored(fingerprints(docs, words_per_shingle))
    roots = _roots(prints, max_bits, paired_list).select("print", "root")
    return one_of_each_group(docs, prints.join(roots, "print").select("doc_id", "mark", "root"))
