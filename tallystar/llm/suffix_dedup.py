"""Removal of repeated byte strings, by sorting sparse suffixes.

A byte goes if a 100-byte string over it also starts earlier: in a document with a
smaller id, or earlier in the same one.

Sorting every suffix of the corpus would move each text a hundred times.  Instead every
100-byte window names an anchor, the place of the smallest hash of its 32-byte strings.
Equal windows name the same place in themselves, so equal windows meet at equal anchors,
and there is one anchor in some thirty bytes.

1. *Anchors* (map side).  Windows with the same anchor are consecutive; they are shipped
   as one entry: hashes of the anchor's string and of the bytes that all of them cover.
   Entries whose hashes a task has seen leave their span here.
2. *Meeting.*  Entries are dealt by the anchor's hash.  Those with equal cover are repeats
   of the earliest.  Anchors met once are done.  Anchors with several covers are in doubt:
   some of their windows may be equal, others not.
3. *Suffixes.*  Only covers in doubt are fetched from their texts.  Their suffixes, one
   per window and cut at 100 bytes, are put in order by deep-shallow sorting: multikey
   quicksort, eight bytes a symbol, to a shallow depth; then, for groups still together,
   blind tries, which look only at the symbol where a group branches.  Windows that are
   together in a leaf are equal in all bytes; all but the earliest leave their span.
4. The spans of each document are merged and cut out of its text.

An anchor that a large part of the corpus shares, such as a common line, has too many
different covers for one task.  Past ``HOT_COVERS`` its windows are dealt one by one, by
their own bytes, and equal ones are merged before they are moved.

What a task holds is bounded by bytes, whatever the corpus and the session's number of
shuffle partitions: texts are counted, and dealt to more tasks where they need them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import small_batches, stored

WINDOW = 100
GRAM = 32
ANCHORED = WINDOW - GRAM + 1
#: Depth, in symbols of eight bytes, at which quicksort hands over to blind tries.
SHALLOW = 3
HOT_COVERS = 20_000
BLOCK_BYTES = 1 << 18
LONG_TEXT = 1 << 20
FLUSH_ENTRIES = 1_000_000
SETTLE_ENTRIES = 3_000_000
SORT_WINDOWS = 2_000_000
SORT_BYTES = 1 << 24
#: Bytes of covers that are held before they are handed on.
COVER_BYTES = 1 << 24
#: Rows of the stored table's payloads.
MET_ROWS = 1 << 18
#: Bytes of text whose entries, covers or spans go to one task.
PIECE_BYTES = 1 << 25
NO_ID = -(1 << 63)

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_BYTE_VALUES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_SYMBOLS = (*range(0, WINDOW - 7, 8), WINDOW - 8)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse modulo 2^64, at least ``n`` of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        inverse = _U(pow(int(_STEP), -1, 1 << 64))
        size = max(n, LONG_TEXT + 4 * WINDOW)
        _POWERS[:] = [
            np.cumprod(np.concatenate(([_U(1)], np.full(size, base, dtype=np.uint64))))
            for base in (_STEP, inverse)]
    return _POWERS[0], _POWERS[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def anchor_entries(data: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """Entries of a block of bytes: key, cover, first window, number of windows, offset.

    ``starts`` are the places, ascending, at which windows of interest start.
    """
    values = _BYTE_VALUES[data]
    gram, factor, width = values, int(_STEP), 1
    while width < GRAM:
        gram = gram[:-width] * _U(factor) + gram[width:]
        factor, width = factor * factor % (1 << 64), 2 * width
    # Hash above place: the smallest is the smallest hash, the leftmost of equals.
    least = (_mixed(gram) & _U(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=np.uint64)
    width = 1
    while 2 * width <= ANCHORED:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < ANCHORED:
        least = np.minimum(least[: len(least) - (ANCHORED - width)], least[ANCHORED - width :])
    anchor = (least[starts] & _U(0xFFFFFFFF)).astype(np.int64)
    begins = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    ends = np.concatenate((begins[1:], [len(anchor)])) - 1
    first, last, anchor = starts[begins], starts[ends], anchor[begins]
    power, inverse = _powers(len(data) + 1)
    running = np.concatenate(([_U(0)], np.cumsum(values * power[: len(values)])))
    cover = (running[last + WINDOW] - running[first]) * inverse[first]
    count = last - first + 1
    return {
        "key": gram[anchor], "cover": _mixed(cover ^ (count.astype(np.uint64) << _U(56))),
        "first": first, "count": count, "offset": anchor - first}


_FIELDS = (("key", "<u8"), ("cover", "<u8"), ("doc", "<i8"), ("first", "<i8"),
           ("count", "<u1"), ("offset", "<u1"))
_SPAN_FIELDS = (("doc", "<i8"), ("start", "<i8"), ("stop", "<i8"))
_ASKED_FIELDS = (("doc", "<i8"), ("first", "<i8"), ("key", "<i8"), ("count", "<u1"),
                 ("offset", "<u1"), ("hot", "<u1"))


def _packed(entries: dict[str, np.ndarray], rows: np.ndarray, fields=_FIELDS) -> bytes:
    """Columns by byte planes, so that bytes which are always zero compress away."""
    return b"".join(
        np.ascontiguousarray(
            entries[name][rows].astype(kind).view(np.uint8).reshape(len(rows), -1).T).tobytes()
        for name, kind in fields)


def _row_bytes(fields) -> int:
    return sum(int(kind[-1]) for _, kind in fields)


def _unpacked(payload: bytes, fields=_FIELDS) -> dict[str, np.ndarray]:
    n, at, out = len(payload) // _row_bytes(fields), 0, {}
    for name, kind in fields:
        width = int(kind[-1])
        planes = np.frombuffer(payload, np.uint8, n * width, at).reshape(width, n)
        out[name] = np.ascontiguousarray(planes.T).view(kind).reshape(n)
        at += n * width
    return out


def _joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs in some column from the row before it; the first row does, if any."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def _leaders(entries: dict[str, np.ndarray]):
    """Split entries into the earliest of each (key, cover) and the spans of the others."""
    order = np.lexsort((entries["first"], entries["doc"], entries["cover"], entries["key"]))
    sorted_ = {k: v[order] for k, v in entries.items()}
    new = _firsts(sorted_["key"], sorted_["cover"])
    leader = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    # A row that repeats an id is not a repeat of itself.
    same = (sorted_["doc"] == sorted_["doc"][leader]) & (sorted_["first"] == sorted_["first"][leader])
    gone = np.flatnonzero(~new & ~same)
    first = sorted_["first"][gone]
    spans = merge_spans(
        sorted_["doc"][gone], first, first + sorted_["count"][gone].astype(np.int64) - 1 + WINDOW)
    return {k: v[new] for k, v in sorted_.items()}, spans


def merge_spans(doc: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Overlapping or touching spans of a document as one, in order."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    of_doc = np.cumsum(np.concatenate(([0], doc[1:] != doc[:-1]))).astype(np.int64)
    reach = np.maximum.accumulate((of_doc << 40) + stop)
    new = np.concatenate(([True], (of_doc[1:] << 40) + start[1:] > reach[:-1]))
    begins = np.flatnonzero(new)
    ends = np.concatenate((begins[1:], [len(doc)])) - 1
    return doc[begins], start[begins], reach[ends] & ((1 << 40) - 1)


def _blocks(ids: list[int], texts: list[bytes]) -> Iterator[dict[str, np.ndarray]]:
    """Entries of many texts: short ones are hashed together, long ones piece by piece."""
    def entries_of(group: list[tuple[int, int, bytes]]) -> dict[str, np.ndarray]:
        data = np.frombuffer(b"".join(text for _, _, text in group), dtype=np.uint8)
        sizes = np.array([len(text) for _, _, text in group], dtype=np.int64)
        begin = np.cumsum(sizes) - sizes
        windows = sizes - WINDOW + 1
        owner = np.repeat(np.arange(len(group)), windows)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        found = anchor_entries(data, begin[owner] + inside)
        owner = np.searchsorted(begin, found["first"], side="right") - 1
        shift = np.array([at for _, at, _ in group], dtype=np.int64) - begin
        found["doc"] = np.array([doc for doc, _, _ in group], dtype=np.int64)[owner]
        found["first"] = found["first"] + shift[owner]
        return found

    group: list[tuple[int, int, bytes]] = []
    size = 0
    for doc, text in zip(ids, texts):
        for at in range(0, max(len(text) - WINDOW + 1, 0), LONG_TEXT):
            piece = text[at : at + LONG_TEXT + WINDOW - 1]
            if group and size + len(piece) > BLOCK_BYTES:
                yield entries_of(group)
                group, size = [], 0
            group.append((doc, at, piece))
            size += len(piece)
    if group:
        yield entries_of(group)


_SHIPPED = "bucket int, doc long, start long, stop long, payload binary"


def _ship(buckets: int):
    def flushed(parts: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
        kept, (doc, start, stop) = _leaders(_joined(parts))
        # Keys are mixed: sums of as many odd numbers, they are all even.
        bucket = (_mixed(kept["key"]) % _U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        groups = np.split(order, cuts) if len(order) else []
        span_bucket = (doc % buckets).astype(np.int32)
        n, m = len(doc), len(groups)
        none = np.zeros(m, dtype=np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([span_bucket, [bucket[g[0]] for g in groups]]).astype(np.int32)),
            pa.array(np.concatenate([doc, none])), pa.array(np.concatenate([start, none])),
            pa.array(np.concatenate([stop, none])),
            pa.array([None] * n + [_packed(kept, g) for g in groups], pa.binary()),
        ], names=["bucket", "doc", "start", "stop", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, waiting = [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                for part in _blocks(batch.column("doc").to_pylist(), texts):
                    parts.append(part)
                    waiting += len(part["key"])
                    if waiting >= FLUSH_ENTRIES:
                        yield flushed(parts)
                        parts, waiting = [], 0
        if parts:
            yield flushed(parts)

    return run


_MET = "doubt boolean, n int, payload binary"


def _met(columns: dict[str, np.ndarray], doubt: bool) -> pa.RecordBatch:
    """Spans, or requests for covers in doubt, packed: checkpoints are not compressed by Spark."""
    fields = _ASKED_FIELDS if doubt else _SPAN_FIELDS
    sizes, payloads = [], []
    for at in range(0, len(columns["doc"]), MET_ROWS):
        rows = np.arange(at, min(at + MET_ROWS, len(columns["doc"])))
        sizes.append(len(rows))
        payloads.append(pa.compress(_packed(columns, rows, fields), codec="zstd", asbytes=True))
    return pa.RecordBatch.from_arrays(
        [pa.array([doubt] * len(sizes), pa.bool_()), pa.array(sizes, pa.int32()),
         pa.array(payloads, pa.binary())], names=["doubt", "n", "payload"])


def _met_spans(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
    return _met({"doc": doc, "start": start, "stop": stop}, doubt=False)


def _met_requests(entries: dict[str, np.ndarray], rows: np.ndarray, hot: bool) -> pa.RecordBatch:
    picked = {k: v[rows] for k, v in entries.items()}
    picked["key"] = picked["key"].view(np.int64)
    return _met(picked | {"hot": np.full(len(picked["doc"]), hot)}, doubt=True)


def _rows_of(fields):
    """The rows that ``_met`` has packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, payload in zip(batch.column("n").to_pylist(), batch.column("payload")):
                raw = pa.decompress(
                    payload.as_buffer(), decompressed_size=n * _row_bytes(fields), codec="zstd", asbytes=True)
                columns = _unpacked(raw, fields)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[c].astype(np.int32 if kind == "<u1" else np.int64))
                     for c, kind in fields], names=[c for c, _ in fields])

    return run


def _cover_counts(entries: dict[str, np.ndarray]) -> np.ndarray:
    """Per entry, how many entries (sorted by key) have its key."""
    begins = np.flatnonzero(_firsts(entries["key"]))
    sizes = np.diff(np.concatenate((begins, [len(entries["key"])])))
    return np.repeat(sizes, sizes)


def _meet(hot_covers: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, waiting, hot_keys = [], 0, np.zeros(0, dtype=np.uint64)
        passed, passing = [], 0

        def settled():
            nonlocal parts, waiting, hot_keys
            kept, spans = _leaders(_joined(parts))
            hot = (_cover_counts(kept) > hot_covers) | np.isin(kept["key"], hot_keys)
            hot_keys = np.union1d(hot_keys, kept["key"][hot])
            out = [_met_spans(*spans), _met_requests(kept, hot, hot=True)]
            parts = [{k: v[~hot] for k, v in kept.items()}]
            waiting = 0
            return out

        for batch in batches:
            spans = batch.filter(pa.compute.is_null(batch.column("payload")))
            if spans.num_rows:
                passed.append([spans.column(c).to_numpy() for c in ("doc", "start", "stop")])
                passing += spans.num_rows
                if passing >= MET_ROWS:
                    yield _met_spans(*map(np.concatenate, zip(*passed)))
                    passed, passing = [], 0
            for payload in batch.column("payload").drop_null():
                parts.append(_unpacked(payload.as_py()))
                waiting += len(parts[-1]["key"])
                if waiting >= SETTLE_ENTRIES:
                    yield from settled()
        if passed:
            yield _met_spans(*map(np.concatenate, zip(*passed)))
        if parts:
            yield from settled()
            yield _met_requests(parts[0], _cover_counts(parts[0]) > 1, hot=False)

    return run


_COVER = "key long, doc long, first long, count int, offset int, cover binary"


def _lists(column: pa.ListArray) -> Iterator[list[np.ndarray]]:
    """Fields of the structs in each list; a null is an empty list."""
    fields = [f.to_numpy() for f in column.flatten().flatten()]
    stops = np.cumsum(pa.compute.list_value_length(column).fill_null(0).to_numpy())
    for start, stop in zip([0, *stops[:-1].tolist()], stops.tolist()):
        yield [f[start:stop] for f in fields]


def _covers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the covers in doubt; hot ones window by window, equal ones once.

    A row of count 0 is the place of a window that is decided already.
    """
    rows: list[tuple] = []
    earliest: dict[bytes, tuple[int, int]] = {}
    held = 0

    def flushed() -> pa.RecordBatch:
        nonlocal held
        for window, (doc, at) in earliest.items():
            digest = hashlib.blake2b(window, digest_size=8).digest()
            rows.append((int.from_bytes(digest, "little", signed=True), doc, at, 1, -1, window))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
            names=["key", "doc", "first", "count", "offset", "cover"])
        rows.clear()
        earliest.clear()
        held = 0
        return out

    for whole in batches:
        for start in range(0, whole.num_rows, 256):
            batch = whole.slice(start, 256)
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for doc, text, asked in zip(
                batch.column("doc").to_pylist(), texts, _lists(batch.column("asked"))
            ):
                for first, key, count, offset, hot in zip(*(f.tolist() for f in asked)):
                    stop = first + count - 1 + WINDOW
                    if stop > len(text):
                        continue  # of another row with this id
                    if not hot:
                        rows.append((key, doc, first, count, offset, text[first:stop]))
                        held += stop - first
                    else:
                        for at in range(first, first + count):
                            window, here = text[at : at + WINDOW], (doc, at)
                            before = earliest.setdefault(window, here)
                            if before != here:
                                earliest[window] = min(before, here)
                                rows.append((0, *max(before, here), 0, 0, b""))
                        held += count * WINDOW
                    if held >= COVER_BYTES:
                        yield flushed()
    if held:
        yield flushed()


def _split(group: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (group, symbol): the order, and the number of each class in it."""
    order = np.lexsort((symbol, group))
    return order, np.cumsum(_firsts(group[order], symbol[order])) - 1


def _together(group: np.ndarray) -> np.ndarray:
    """Rows, of a sorted grouping, that are not alone in their group."""
    before = _firsts(group)
    after = np.ones(len(group), dtype=bool)
    after[:-1] = before[1:]
    return ~(before & after)


def equal_windows(symbols: np.ndarray, at: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows equal in all bytes to another of their group: (rows, class of each), sorted.

    ``symbols[p]`` is the big-endian word of the eight bytes at p; windows start at ``at``.
    """
    rows = np.arange(len(at))

    def keep(order: np.ndarray, classes: np.ndarray) -> None:
        nonlocal rows, group
        stay = _together(classes)
        rows, group = rows[order][stay], classes[stay]

    keep(*_split(group, np.zeros(len(group), dtype=np.uint64)))
    # Multikey quicksort: one symbol a round, groups of one are in place.
    for depth in range(SHALLOW):
        keep(*_split(group, symbols[at[rows] + _SYMBOLS[depth]]))
    # Blind tries: each group goes straight to the symbol at which it branches.
    done_rows, done_class, classes_so_far, depth = [], [], 0, SHALLOW
    while len(rows):
        begins = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        sizes = np.diff(np.concatenate((begins, [len(group)])))
        first = np.repeat(rows[begins], sizes)
        common = np.full(len(rows), depth)
        same = np.ones(len(rows), dtype=bool)
        for d in range(depth, len(_SYMBOLS)):
            same &= symbols[at[rows] + _SYMBOLS[d]] == symbols[at[first] + _SYMBOLS[d]]
            common += same
        branch = np.repeat(np.minimum.reduceat(common, begins), sizes)
        leaf = branch == len(_SYMBOLS)
        if leaf.any():
            _, numbers = np.unique(group[leaf], return_inverse=True)
            done_rows.append(rows[leaf])
            done_class.append(numbers + classes_so_far)
            classes_so_far += int(numbers.max()) + 1
        rows, group, branch = rows[~leaf], group[~leaf], branch[~leaf]
        if len(rows):
            offsets = np.array(_SYMBOLS)[branch]
            keep(*_split(group, symbols[at[rows] + offsets]))
    if not done_rows:
        return rows, group
    return np.concatenate(done_rows), np.concatenate(done_class)


def _repeats(key, doc, first, count, offset, covers: list[bytes]):
    """Spans of the windows, of covers with their anchors' keys, that are not the earliest."""
    data = np.frombuffer(b"".join(covers) + bytes(8), dtype=np.uint8)
    begin = np.cumsum([0] + [len(c) for c in covers[:-1]])
    symbols = np.zeros(len(data) - 7, dtype=np.uint64)
    for k in range(8):
        symbols = (symbols << _U(8)) | data[k : len(data) - 7 + k]
    cover = np.repeat(np.arange(len(covers)), count)
    inside = np.arange(len(cover)) - np.repeat(np.cumsum(count) - count, count)
    # Equal windows have their anchor at the same place.
    order, place = _split(key[cover].view(np.uint64), (offset[cover] - inside + WINDOW).astype(np.uint64))
    group = np.empty(len(cover), dtype=np.int64)
    group[order] = place
    rows, classes = equal_windows(symbols, begin[cover] + inside, group)
    docs, places = doc[cover[rows]], first[cover[rows]] + inside[rows]
    order = np.lexsort((places, docs, classes))
    docs, places, classes = docs[order], places[order], classes[order]
    new = _firsts(classes)
    leader = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    gone = ~new & ~((docs == docs[leader]) & (places == places[leader]))
    return merge_spans(docs[gone], places[gone], places[gone] + WINDOW)


def _sort_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key; whole keys are sorted together, up to a block at a time."""
    def spans(doc, start, stop) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(stop, pa.int64())],
            names=["doc", "start", "stop"])

    def sorted_block(table: pa.Table) -> pa.RecordBatch:
        column = lambda c: table.column(c).to_numpy()
        return spans(*_repeats(
            column("key"), column("doc"), column("first"), column("count"), column("offset"),
            table.column("cover").to_pylist()))

    def sizes(covers: pa.RecordBatch | pa.Table) -> np.ndarray:
        windows = int(covers.column("count").to_numpy().sum())
        return np.array([windows, windows + (WINDOW - 1) * covers.num_rows])

    held: list[pa.RecordBatch] = []
    waiting = np.zeros(2, dtype=np.int64)
    for batch in batches:
        decided = pa.compute.equal(batch.column("count"), 0)
        if decided.true_count:
            done = batch.filter(decided)
            first = done.column("first").to_numpy()
            yield spans(*merge_spans(done.column("doc").to_numpy(), first, first + WINDOW))
            batch = batch.filter(pa.compute.invert(decided))
        if not batch.num_rows:
            continue
        held.append(batch)
        waiting = waiting + sizes(batch)
        if waiting[0] >= SORT_WINDOWS or waiting[1] >= SORT_BYTES:
            table = pa.Table.from_batches(held)
            keys = table.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1], side="left"))
            if cut:
                yield sorted_block(table.slice(0, cut))
                rest = table.slice(cut)
                held = rest.to_batches()
                waiting = sizes(rest)
    if held:
        yield sorted_block(pa.Table.from_batches(held))


_SPAN = "doc long, start long, stop long"
_CUT = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for first in range(0, whole.num_rows, 256):
            batch, rows = whole.slice(first, 256), []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for doc, text, spans in zip(
                batch.column("doc").to_pylist(), texts, _lists(batch.column("spans"))
            ):
                digest, at, removed, runs = hashlib.sha256(), 0, 0, 0
                for start, stop in _runs(*spans, len(text)):
                    digest.update(text[at:start])
                    at, removed, runs = stop, removed + stop - start, runs + 1
                digest.update(text[at:])
                rows.append((None if doc == NO_ID else doc, len(text), removed, runs, digest.hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _runs(start: np.ndarray, stop: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal runs of a document's spans, within its bytes."""
    if not len(start):
        return []
    stop = np.minimum(stop, size)
    good = start < stop
    one = np.zeros(int(good.sum()), dtype=np.int64)
    _, start, stop = merge_spans(one, start[good], stop[good])
    return list(zip(start.tolist(), stop.tolist()))


def _tasks(texts: DataFrame) -> int:
    """Tasks that the texts are dealt to: as many as the session says, or as their bytes need."""
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(partitions, -(-n_bytes // PIECE_BYTES))


def repeated_spans(docs: DataFrame, hot_covers: int = HOT_COVERS) -> tuple[DataFrame, DataFrame]:
    """Texts, (doc, text), and spans to remove, (doc, start, stop), both dealt by document.

    A null id is the smallest.  Spans of a document may overlap.
    """
    texts = small_batches(docs).select(
        F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("doc"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    tasks = _tasks(texts)
    # Buckets are dealt by number: hashed, several would meet in one task.
    shipped = texts.mapInArrow(_ship(tasks), _SHIPPED).repartitionById(tasks, F.col("bucket"))
    met = stored(shipped.mapInArrow(_meet(hot_covers), _MET))
    dealt = texts.repartition(tasks, "doc")
    requests = met.where("doubt").mapInArrow(
        _rows_of(_ASKED_FIELDS), "doc long, first long, key long, count int, offset int, hot int")
    asked = requests.repartition(tasks, "doc").groupBy("doc").agg(
        F.collect_list(F.struct("first", "key", "count", "offset", "hot")).alias("asked"))
    covers = dealt.join(asked.hint("shuffle_hash"), "doc").mapInArrow(_covers, _COVER)
    sorted_out = covers.repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(
        _sort_suffixes, _SPAN)
    settled = met.where(~F.col("doubt")).mapInArrow(_rows_of(_SPAN_FIELDS), _SPAN)
    return dealt, settled.unionByName(sorted_out).repartition(tasks, "doc")


def without_repeats(docs: DataFrame, hot_covers: int = HOT_COVERS) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A null text is empty.  Texts of fewer than 100 bytes stay whole.  A null id counts as
    the smallest.  Rows that repeat an id are one document read several times: they do
    not remove each other, and spans found in one apply to all, within their length.  An
    empty table gives an empty result.  Other columns are not read.
    """
    dealt, spans = repeated_spans(docs, hot_covers)
    by_doc = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    joined = dealt.join(by_doc.hint("shuffle_hash"), "doc", "left")
    return joined.mapInArrow(_cut, _CUT)
