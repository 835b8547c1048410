"""Best-fit packing of documents into sequences of at most 4096 tokens.

Two steps.  Every document is tokenized where it lies and leaves only the lengths of its
pieces.  Then the pieces, in hash order, run through a bounded-space online best-fit:
a fixed number of open bins, indexed by free space in the bits of one integer, so the
bin that fits best is the lowest set bit not below the piece.  When no bin fits and all
are open, the fullest is closed for good.  Lost tasks rerun to the same answer, because
the order of the pieces is a function of their ids.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallystar.llm.common import small_batches, stored

SEQUENCE_TOKENS = 4096
END_ID = 1
OPEN_BINS = 2048
TOKENIZER = "word_bpe_49k.json"
#: Pieces that one task packs, about: some hundred thousand sequences share 2048 open bins.
PIECES_PER_TASK = 500_000
#: Words whose ids a task remembers, some 30 MB, before it forgets the later half.
REMEMBERED_WORDS = 200_000
ROWS_AT_ONCE = 256
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"

def _byte_letters() -> dict[int, int]:
    """The visible character by which byte-level BPE writes each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()
_MARKS = bytes(range(0x21, 0x30)) + b":;<=>?@[\\]^_`{|}~"
#: Letters below this need no normalising once they are lower case and composed.
_LATIN_END = "\u0250"
_SPECIAL = b"<|"


class WordIds(dict):
    """Ids of words, packed as little-endian 32-bit integers; each is encoded once.

    The tokenizer drops white space and never joins across it, so the ids of a text are
    the ids of its words between ASCII spaces, in order.  It lower-cases, so case is not
    remembered.  A word of Latin letters and the punctuation after it are single runs of
    the tokenizer's pattern and go to its model directly; anything else goes through the
    whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model

    def _run(self, run: bytes) -> bytes:
        written = run.decode("latin-1").translate(_BYTE_LETTERS)
        return array("I", [t.id for t in self.model.tokenize(written)]).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        core = word.rstrip(_MARKS)
        letters = core.decode()
        if core and not (
            letters.isalpha() and max(letters) < _LATIN_END and letters == letters.lower()
        ):
            coded = self.tokenizer.encode(word.decode(), add_special_tokens=False)
            ids = array("I", coded.ids).tobytes()
        elif core and len(core) < len(word):
            ids = self[core] + self[word[len(core) :]]
        else:
            ids = self._run(word)
        self[word] = ids
        return ids

    def forget(self, remembered: int) -> None:
        """Keep the older half when there are too many: words met first are met most."""
        if len(self) > remembered:
            keep = list(islice(self.items(), remembered // 2))
            self.clear()
            self.update(keep)

    def of_text(self, text: bytes) -> bytes:
        # A special token's name is only that in lower case, so such texts keep their case.
        words = (text if _SPECIAL in text else text.lower()).split()
        return b"".join(map(self.__getitem__, words))


def _pieces(path: str, capacity: int):
    tail = np.asarray([END_ID], dtype="<u4").tobytes()
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = WordIds(path)  # the task's own, so that nothing outlives it
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                rows: list[tuple] = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                    ids = ids_of.of_text(text) + tail
                    for k, cut in enumerate(range(0, len(ids), step)):
                        part = ids[cut : cut + step]
                        rows.append((doc_id, k, cut // 4, len(part) // 4, zlib.crc32(part)))
                ids_of.forget(REMEMBERED_WORDS)
                columns = list(zip(*rows)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (
                        pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def document_pieces(
    docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = SEQUENCE_TOKENS
) -> DataFrame:
    """Pieces of every row's tokens, the end id included; a null text has only the end id."""
    path = public_tokenizers.path(tokenizer)
    texts = small_batches(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(_pieces(path, capacity), PIECE_SCHEMA)


class BestFit:
    """Online best-fit with at most ``open_bins`` bins open at once."""

    def __init__(self, capacity: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS) -> None:
        self.capacity, self.open_bins = capacity, open_bins
        self.free_bits = 0
        self.by_free: dict[int, list[int]] = {}
        self.n_open = 0
        self.n_bins = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.free_bits ^= 1 << free
        self.n_open -= 1
        return number

    def _lowest(self, at_least: int) -> int:
        bits = self.free_bits >> at_least
        return at_least + (bits & -bits).bit_length() - 1 if bits else -1

    def place(self, length: int) -> tuple[int, int]:
        """Bin number and offset of the next piece."""
        free = self._lowest(length)
        if free >= 0:
            number = self._take(free)
        else:
            if self.n_open >= self.open_bins:
                self._take(self._lowest(0))  # the fullest closes
            number, free = self.n_bins, self.capacity
            self.n_bins += 1
        left = free - length
        if left:
            self.by_free.setdefault(left, []).append(number)
            self.free_bits |= 1 << left
            self.n_open += 1
        return number, self.capacity - free


def _pack(capacity: int, open_bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = None
        for batch in batches:
            shards = batch.column("shard").to_pylist()
            lengths = batch.column("length").to_pylist()
            if shards and fit is None:
                fit, first = BestFit(capacity, open_bins), shards[0] << 40
            placed = [fit.place(length) for length in lengths]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array([first + number for number, _ in placed], pa.int64()),
                 pa.array([offset for _, offset in placed], pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32",
                       "sequence_id", "offset"])

    return run


def best_fit_pack(
    pieces: DataFrame,
    capacity: int = SEQUENCE_TOKENS,
    open_bins: int = OPEN_BINS,
    pieces_per_task: int = PIECES_PER_TASK,
) -> DataFrame:
    """Give every piece a sequence and a place in it.

    ``pieces`` has doc_id, piece, start, length (1 to ``capacity``) and ids_crc32, and is
    run twice, so it must be stored.  Only sums of lengths reach the driver.  Pieces are
    dealt by hash to as few tasks as their number asks for, since each task leaves its
    open bins partly filled.  Equal rows are separate pieces.
    """
    tasks = max(1, -(-pieces.count() // pieces_per_task))
    order = F.xxhash64("doc_id", "piece")
    dealt = (
        pieces.withColumn("order", order)
        .repartition(tasks, "order")
        .withColumn("shard", F.spark_partition_id().cast("long"))
        .sortWithinPartitions("order", "doc_id", "piece", "start")
    )
    return dealt.mapInArrow(
        _pack(capacity, open_bins), PIECE_SCHEMA + ", sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, **options) -> DataFrame:
    """Pieces of all documents with their sequences.

    Nulls: a null text is empty, one piece of the end id; a null id stays null.  A long
    text is cut into full pieces and a rest.  Repeated rows are packed once each.  An
    empty table packs into nothing.  Other columns are not read.
    """
    return best_fit_pack(stored(document_pieces(docs, tokenizer)), **options)
