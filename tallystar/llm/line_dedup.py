"""Lines that many documents repeat, dropped from all but one of them.

Lines are exploded and normalised to keys where the texts lie; only a 128-bit hash of
each key, with the document and the position, leaves for the count of documents per
hash.  Hashes over the threshold mark positions to drop, which go back to their
documents; what is left of a text is put together by position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from tallystar.llm.common import SPACES, row_mark, small_batches, stored

#: Fixed values of the contract: code points of a key and documents that hold it, at least.
KEY_LENGTH = 20
DOCUMENTS = 3
#: Keys of at least 1/FREQUENT of all lines, which cannot be more than FREQUENT, are broadcast.
FREQUENT = 100_000

_BLANK = SPACES.encode()
_LINE = "doc_id long, mark long, pos int, first boolean, high long, low long"


def _keyed_lines(key_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, spots, firsts, digests = [], [], [], []
            for row, text in enumerate(batch.column("text").cast(pa.binary())):
                seen = set()
                for spot, line in enumerate(text.as_py().split(b"\n")):
                    key = line.strip(_BLANK).lower()  # bytes: only A-Z change
                    if len(key) < key_length:
                        continue
                    if not key.isascii() and len(key.decode(errors="replace")) < key_length:
                        continue
                    digest = xxhash.xxh3_128_digest(key)
                    rows.append(row)
                    spots.append(spot)
                    firsts.append(digest not in seen)
                    seen.add(digest)
                    digests.append(digest)
            halves = np.frombuffer(b"".join(digests), dtype=">i8").astype(np.int64).reshape(-1, 2)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("mark").take(at),
                 pa.array(spots, pa.int32()), pa.array(firsts, pa.bool_()),
                 pa.array(halves[:, 0]), pa.array(halves[:, 1])],
                names=["doc_id", "mark", "pos", "first", "high", "low"])

    return run


def _marked(docs: DataFrame, *columns: Column | str) -> DataFrame:
    return small_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), row_mark(F.col("text")).alias("mark"), *columns)


def keyed_lines(docs: DataFrame, key_length: int = KEY_LENGTH) -> DataFrame:
    """(doc_id, mark, pos, first, high, low): the lines whose key is long enough.

    ``first`` tells a key's first line in its document, ``high`` and ``low`` are its hash.
    """
    texts = _marked(docs, F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(_keyed_lines(key_length), _LINE)


def repeated_keys(lines: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """(high, low, n, keeper): hashes found in enough documents, and the largest id of these."""
    return lines.groupBy("high", "low").agg(
        F.count_if("first").alias("n"), F.max("doc_id").alias("keeper")
    ).where(F.col("n") >= documents)


def dropped_positions(
    docs: DataFrame, key_length: int = KEY_LENGTH, documents: int = DOCUMENTS,
    frequent: int = FREQUENT,
) -> DataFrame:
    """(doc_id, mark, gone): positions of the lines that go, for every text that loses any.

    No more than ``frequent`` keys can each make up 1/``frequent`` of all lines: these
    are broadcast to the lines, so that no task receives all lines of a frequent key.
    The other keys are few per key and are joined by hash.
    """
    lines = keyed_lines(docs, key_length)
    keys = stored(repeated_keys(lines, documents))
    total = keys.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") >= total / frequent
    hash_of, columns = ["high", "low"], ["doc_id", "mark", "pos"]
    leaves = ~F.col("doc_id").eqNullSafe(F.col("keeper"))
    gone = lines.join(F.broadcast(keys.where(often)), hash_of).where(leaves).select(columns)
    rest = keys.where(~often)
    if not rest.isEmpty():
        gone = gone.union(lines.join(rest, hash_of).where(leaves).select(columns))
    return gone.groupBy("doc_id", "mark").agg(F.collect_set("pos").alias("gone"))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, lines, losses = [], [], []
        bodies = pc.struct_field(batch.column("row"), "text").cast(pa.binary())
        for text, gone in zip(bodies.to_pylist(), batch.column("gone").to_pylist(), strict=True):
            split = (text or b"").split(b"\n")
            out = set(gone or ())
            lines.append(len(split))
            losses.append(len(out))
            texts.append(
                b"\n".join(line for spot, line in enumerate(split) if spot not in out) if out else text)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()),
             pa.array(losses, pa.int64())],
            names=["row", "kept_text", "n_lines", "n_dropped"])


def without_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """(row, kept_text, n_lines, n_dropped): every row of ``docs``, its text without the
    lines that repeat across documents.

    ``row`` is the input row as a struct, whatever its columns are called.  A null or
    empty text is one empty line; a text that loses no line is returned as it is, a null
    one as null, and one that loses all its lines is empty.  Every row is a document of
    its own, also where an id repeats or is null.  A key stays in the rows that carry the
    largest id that holds it; a null id is less than any other and stays only where no
    row with the key has an id.  Repeated rows get equal answers; an empty table gives an
    empty result.
    """
    positions = dropped_positions(docs, **options).select(
        F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark"), "gone")
    rows = _marked(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = rows.join(
        positions,
        F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("mark") == F.col("gone_mark")), "left")
    shape = StructType().add("row", rows.schema["row"].dataType).add("kept_text", StringType())
    return joined.select("row", "gone").mapInArrow(
        _kept, shape.add("n_lines", LongType()).add("n_dropped", LongType()))
