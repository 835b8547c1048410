"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text is cut into overlapping windows of words.  A word enters as a hashed word vector,
the vector of its first characters, and the mean vector of its character four-grams.  A
gated recurrent network reads each window in both directions, attention pools its states,
and a logistic unit scores the pool.  A text's score is that of its worst window, over
all windows of the whole text.

The network is trained in numpy on the driver, from a bounded sample of labelled rows
(``TRAIN_ROWS``, half of them toxic, up to ``TRAIN_WINDOWS`` windows each).  A label
belongs to a text, not to a window, so every round trains on the windows that the network
itself finds worst, and on as many others of texts that are not toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import held_out

WINDOW = 32
STRIDE = 16
TRAIN_ROWS = 2400
TRAIN_WINDOWS = 48
ROUNDS = 4
#: A small sample is gone over again until the network has taken so many steps.
LEAST_STEPS = 120
#: A bucket in fewer texts of the sample than this is unknown: its vector stays zero.
LEAST_TEXTS = 6
BATCH = 128
RATE = 0.01
STATES = 8
WORD_BUCKETS, WORD_SIZE = 1 << 16, 8
HEAD_BUCKETS, HEAD_SIZE, HEAD_BYTES = 1 << 15, 6, 5
GRAM_BUCKETS, GRAM_SIZE = 1 << 14, 4
PIECE_BYTES = 1 << 19
OVERLAP_BYTES = 4096

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_LETTER = np.zeros(256, dtype=np.uint8)
_LETTER[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
_LETTER[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[128:] = np.arange(128, 256)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 2 * PIECE_BYTES)
        _POWERS[:] = [
            np.cumprod(np.concatenate(([_U(1)], np.full(size, base, dtype=np.uint64))))
            for base in (_BASE, _INVERSE)]
    return _POWERS


def _bucket(x: np.ndarray, size: int) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> _U(29))) % _U(size)).astype(np.int32)


@dataclass
class Words:
    """Words of some texts: bucket numbers, and where each text's words begin."""

    word: np.ndarray
    head: np.ndarray
    gram: np.ndarray
    gram_begin: np.ndarray
    gram_count: np.ndarray
    text_begin: np.ndarray


def read_words(texts: list[bytes]) -> Words:
    """Runs of letters and digits, lower-cased, of UTF-8 texts."""
    data = _LETTER[np.frombuffer(b" " + b" ".join(texts) + b" ", dtype=np.uint8)]
    inside = data > 0
    begin = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    end = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    power, inverse = _powers(len(data) + 1)
    running = np.concatenate(([_U(0)], np.cumsum((data.astype(np.uint64) + _U(7)) * power[: len(data)])))
    hashed = lambda a, b: (running[b] - running[a]) * inverse[a]
    head_end = np.minimum(end, begin + HEAD_BYTES)
    # Four-grams centred in a word, the blanks around it included.
    code = data.astype(np.uint32)
    four = np.zeros(len(code), dtype=np.uint32)
    four[1:-2] = code[:-3] | (code[1:-2] << 8) | (code[2:-1] << 16) | (code[3:] << 24)
    count = end - begin
    gram = (four[inside] * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BUCKETS.bit_length() + 1)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    starts = 1 + np.cumsum(sizes) - sizes
    return Words(
        _bucket(hashed(begin, end), WORD_BUCKETS), _bucket(hashed(begin, head_end), HEAD_BUCKETS),
        gram.astype(np.int32), np.cumsum(count) - count, count,
        np.concatenate((np.searchsorted(begin, starts), [len(begin)])))


def windows_of(begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All overlapping windows of texts: first word, number of words, text."""
    sizes = np.diff(begin)
    count = np.where(sizes > 0, np.maximum(1, -(-(sizes - WINDOW) // STRIDE) + 1), 0)
    text = np.repeat(np.arange(len(sizes)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    first = begin[:-1][text] + number * STRIDE
    return first, np.minimum(WINDOW, begin[1:][text] - first), text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(seed: int = 3) -> Network:
        draw = np.random.default_rng(seed)
        h, x = STATES, WORD_SIZE + HEAD_SIZE + GRAM_SIZE
        f = lambda *shape, scale: draw.normal(0, scale, shape).astype(np.float32)
        p = {
            "word": f(WORD_BUCKETS, WORD_SIZE, scale=0.05),
            "head": f(HEAD_BUCKETS, HEAD_SIZE, scale=0.05),
            "gram": f(GRAM_BUCKETS, GRAM_SIZE, scale=0.05),
            "wa": f(2 * h, 2 * h, scale=0.3), "ba": np.zeros(2 * h, np.float32),
            "va": f(2 * h, scale=0.3), "wo": f(2 * h, scale=0.3), "bo": np.zeros(1, np.float32)}
        for way in "fb":
            p[f"x{way}"] = f(x, 3 * h, scale=0.4)
            p[f"h{way}"] = f(h, 3 * h, scale=0.3)
            p[f"c{way}"] = np.zeros(3 * h, np.float32)
        return Network(p)

    def inputs(self, words: Words) -> np.ndarray:
        grams = self.p["gram"][words.gram]
        pooled = np.add.reduceat(grams, words.gram_begin, axis=0) if len(words.word) else grams
        return np.hstack([
            self.p["word"][words.word], self.p["head"][words.head],
            pooled / np.maximum(words.gram_count, 1)[:, None].astype(np.float32)])

    def _read(self, way: str, gates: np.ndarray, at: np.ndarray, mask: np.ndarray, keep: bool):
        h, u = STATES, self.p[f"h{way}"]
        state = np.zeros((len(at), h), np.float32)
        states = np.zeros((WINDOW, len(at), h), np.float32)
        kept = []
        for t in range(WINDOW) if way == "f" else range(WINDOW - 1, -1, -1):
            m = mask[:, t : t + 1]
            a, b = gates[at[:, t]], state @ u
            rz = _sigmoid(a[:, : 2 * h] + b[:, : 2 * h])
            r, z = rz[:, :h], rz[:, h:]
            n = np.tanh(a[:, 2 * h :] + r * b[:, 2 * h :])
            if keep:
                kept.append((t, state, r, z, n, b[:, 2 * h :], m))
            state = state + m * (1 - z) * (n - state)
            states[t] = state
        return states, kept

    def forward(self, words: Words, first: np.ndarray, count: np.ndarray, keep: bool = False):
        """Logit of each window."""
        x = self.inputs(words)
        steps = np.arange(WINDOW)
        at = np.minimum(first[:, None] + steps, max(len(x) - 1, 0))
        mask = (steps < count[:, None]).astype(np.float32)
        p = self.p
        both, tapes = [], []
        for way in "fb":
            states, tape = self._read(way, x @ p[f"x{way}"] + p[f"c{way}"], at, mask, keep)
            both.append(states)
            tapes.append(tape)
        s = np.concatenate(both, axis=2)
        e = np.tanh(s @ p["wa"] + p["ba"])
        logit = e @ p["va"] - 1e9 * (1 - mask.T)
        share = np.exp(logit - logit.max(axis=0))
        share /= share.sum(axis=0)
        pool = (share[:, :, None] * s).sum(axis=0)
        out = pool @ p["wo"] + p["bo"][0]
        return (out, (x, at, mask, tapes, s, e, share, pool)) if keep else out

    def backward(self, words: Words, tape, d_out: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients, given those of the logits."""
        p, h = self.p, STATES
        x, at, mask, tapes, s, e, share, pool = tape
        g = {"wo": pool.T @ d_out, "bo": np.array([d_out.sum()], np.float32)}
        d_pool = d_out[:, None] * p["wo"]
        d_s = share[:, :, None] * d_pool
        d_share = (s * d_pool).sum(axis=2)
        d_logit = share * (d_share - (share * d_share).sum(axis=0))
        g["va"] = np.einsum("tb,tbh->h", d_logit, e)
        d_e = d_logit[:, :, None] * p["va"] * (1 - e * e)
        g["wa"] = np.einsum("tbi,tbj->ij", s, d_e)
        g["ba"] = d_e.sum(axis=(0, 1))
        d_s = d_s + d_e @ p["wa"].T
        d_x = np.zeros_like(x)
        for k, way in enumerate("fb"):
            u, d_state = p[f"h{way}"], np.zeros((len(at), h), np.float32)
            g_u = np.zeros_like(u)
            d_gates = np.zeros((len(at), WINDOW, 3 * h), np.float32)
            for t, before, r, z, n, un, m in reversed(tapes[k]):
                d = d_state + d_s[t, :, k * h : (k + 1) * h]
                d_new = m * d
                d_n = d_new * (1 - z) * (1 - n * n)
                d_z = d_new * (before - n) * z * (1 - z)
                d_r = d_n * un * r * (1 - r)
                d_gates[:, t] = np.hstack([d_r, d_z, d_n])
                d_u = np.hstack([d_r, d_z, d_n * r])
                g_u += before.T @ d_u
                d_state = d - d_new * (1 - z) + d_u @ u.T
            flat, index = d_gates.reshape(-1, 3 * h), at.reshape(-1)
            per_word = np.zeros((len(x), 3 * h), np.float32)
            np.add.at(per_word, index, flat)
            g[f"h{way}"], g[f"c{way}"] = g_u, flat.sum(axis=0)
            g[f"x{way}"] = x.T @ per_word
            d_x += per_word @ p[f"x{way}"].T
        a, b = WORD_SIZE, WORD_SIZE + HEAD_SIZE
        for name, ids, part in (("word", words.word, d_x[:, :a]), ("head", words.head, d_x[:, a:b])):
            g[name] = np.zeros_like(p[name])
            np.add.at(g[name], ids, part)
        d_gram = d_x[:, b:] / np.maximum(words.gram_count, 1)[:, None]
        g["gram"] = np.zeros_like(p["gram"])
        np.add.at(g["gram"], words.gram, np.repeat(d_gram, words.gram_count, axis=0))
        return g

    def text_logits(self, texts: list[bytes]) -> np.ndarray:
        """Worst window of each text; minus infinity where there is no word."""
        worst = np.full(len(texts), -np.inf)
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size + len(texts[stop]) <= PIECE_BYTES):
                size += len(texts[stop])
                stop += 1
            pieces, owner = [], []
            for k in range(start, stop):
                for piece in _pieces(texts[k]):
                    pieces.append(piece)
                    owner.append(k)
            for at in range(0, len(pieces), 1 if stop - start == 1 else len(pieces)):
                group = pieces[at : at + (1 if stop - start == 1 else len(pieces))]
                words = read_words(group)
                first, count, text = windows_of(words.text_begin)
                if len(first):
                    logits = self.forward(words, first, count)
                    np.maximum.at(worst, np.array(owner[at : at + len(group)])[text], logits)
            start = stop
        return worst


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text in pieces that overlap by more than a window's words."""
    at = 0
    while True:
        stop = at + PIECE_BYTES
        if stop >= len(text):
            yield text[at:]
            return
        cut = max(text.rfind(b" ", at + PIECE_BYTES // 2, stop), text.rfind(b"\n", at + PIECE_BYTES // 2, stop))
        cut = stop if cut < 0 else cut
        yield text[at:cut]
        back = text.find(b" ", cut - OVERLAP_BYTES, cut)
        at = cut if back < 0 else back


@dataclass
class Sample:
    """Windows of labelled texts."""

    words: Words
    first: np.ndarray
    count: np.ndarray
    text: np.ndarray
    toxic: np.ndarray


def sample_of(windows: list[list[bytes]], toxic: list[int]) -> Sample:
    """Words of all windows, read a block at a time so that little is held at once."""
    flat = [w for text in windows for w in text]
    parts, start = [], 0
    while start < len(flat):
        stop, size = start, 0
        while stop < len(flat) and (stop == start or size + len(flat[stop]) <= PIECE_BYTES):
            size += len(flat[stop])
            stop += 1
        parts.append(read_words(flat[start:stop]))
        start = stop
    n_words = np.cumsum([0] + [len(p.word) for p in parts])
    n_grams = np.cumsum([0] + [len(p.gram) for p in parts])
    words = Words(
        *[np.concatenate([getattr(p, name) for p in parts]) for name in ("word", "head", "gram")],
        np.concatenate([p.gram_begin + n for p, n in zip(parts, n_grams)]),
        np.concatenate([p.gram_count for p in parts]),
        np.concatenate([p.text_begin[:-1] + n for p, n in zip(parts, n_words)] + [n_words[-1:]]))
    owner = np.repeat(np.arange(len(windows)), [len(t) for t in windows])
    first = words.text_begin[:-1]
    count = np.minimum(np.diff(words.text_begin), WINDOW)
    some = count > 0
    return Sample(words, first[some], count[some], owner[some], np.array(toxic, dtype=np.int64))


def _prior(sample: Sample, ids: np.ndarray, texts: np.ndarray, size: int):
    """How much more often a bucket stands in toxic texts, shrunk where it is rare; and
    whether it is known at all."""
    pairs = np.unique(texts.astype(np.int64) * size + ids)
    toxic = sample.toxic[pairs // size] == 1
    inside = np.bincount(pairs[toxic] % size, minlength=size)
    outside = np.bincount(pairs[~toxic] % size, minlength=size)
    share = max((sample.toxic == 1).sum(), 1) / max((sample.toxic == 0).sum(), 1)
    excess = (inside - outside * share) / np.sqrt(inside + outside * share + 4)
    known = inside + outside >= LEAST_TEXTS
    return (np.clip(excess, -3, 3) / 3 * known).astype(np.float32), known.astype(np.float32)


def train(sample: Sample, rounds: int = ROUNDS, seed: int = 3) -> tuple[Network, float]:
    """Fit the network; returns it with the shift that puts its best cut at 0."""
    net, draw = Network.fresh(seed), np.random.default_rng(seed)
    w = sample.words
    owner = np.zeros(len(w.word), dtype=np.int64)
    for first, count, text in zip(sample.first, sample.count, sample.text):
        owner[first : first + count] = text
    known = {}
    for name, ids, texts, size in (
        ("word", w.word, owner, WORD_BUCKETS), ("head", w.head, owner, HEAD_BUCKETS),
        ("gram", w.gram, np.repeat(owner, w.gram_count), GRAM_BUCKETS),
    ):
        prior, of_bucket = _prior(sample, ids, texts, size)
        known[name] = of_bucket[:, None]
        net.p[name] *= known[name]
        net.p[name][:, 0] = prior
    word, head = net.p["word"][:, 0].copy(), net.p["head"][:, 0].copy()
    # Before the first round, a window is as bad as its worst word.
    worst_word = word[w.word] + head[w.head]
    score = np.array([worst_word[a : a + n].max() for a, n in zip(sample.first, sample.count)])
    of_window = sample.toxic[sample.text]
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    step = 0
    taken = 0
    while taken < rounds or step < LEAST_STEPS:
        taken += 1
        order = np.lexsort((-score, sample.text))
        rank = np.arange(len(order)) - np.searchsorted(sample.text[order], sample.text[order], side="left")
        top = order[rank < 2]
        # A toxic text's worst window is toxic; a second one may not be.
        positive = order[(rank < 1) & (of_window[order] == 1)]
        hard = top[of_window[top] == 0]
        other = np.flatnonzero(of_window == 0)
        easy = draw.choice(other, size=min(len(other), len(positive)), replace=False)
        chosen = draw.permutation(np.concatenate([positive, positive, hard, easy]))
        for at in range(0, len(chosen), BATCH):
            pick = chosen[at : at + BATCH]
            part, first = _subset(w, sample.first[pick], sample.count[pick])
            out, tape = net.forward(part, first, sample.count[pick], keep=True)
            d_out = ((_sigmoid(out) - of_window[pick]) / len(pick)).astype(np.float32)
            step += 1
            rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for name, gradient in net.backward(part, tape, d_out).items():
                gradient = gradient * known[name] if name in known else gradient
                m, v = moments[name]
                m += 0.1 * (gradient - m)
                v += 0.001 * (gradient * gradient - v)
                net.p[name] -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
        score = np.concatenate([
            net.forward(*_subset(w, sample.first[a : a + 2048], sample.count[a : a + 2048]),
                        sample.count[a : a + 2048])
            for a in range(0, len(sample.first), 2048)])
    worst = np.full(len(sample.toxic), -np.inf)
    np.maximum.at(worst, sample.text, score)
    return net, _best_cut(worst, sample.toxic)


def _subset(w: Words, first: np.ndarray, count: np.ndarray) -> tuple[Words, np.ndarray]:
    """The words of some windows, and where each window begins in them."""
    begin = np.cumsum(count) - count
    rows = np.repeat(first - begin, count) + np.arange(int(count.sum()))
    grams = w.gram_count[rows]
    gram_begin = np.cumsum(grams) - grams
    at = np.repeat(w.gram_begin[rows] - gram_begin, grams) + np.arange(int(grams.sum()))
    return Words(w.word[rows], w.head[rows], w.gram[at], gram_begin, grams, begin), begin


def _best_cut(logits: np.ndarray, toxic: np.ndarray) -> float:
    """Middle of the gap at which fewest texts of the balanced sample are wrong."""
    good = np.isfinite(logits)
    logits, toxic = logits[good], toxic[good]
    order = np.argsort(logits)
    x, y = logits[order], toxic[order]
    wrong = np.concatenate(([0], np.cumsum(y == 1))) + (y == 0).sum() - np.concatenate(([0], np.cumsum(y == 0)))
    k = np.flatnonzero(wrong == wrong.min())
    k = int(k[len(k) // 2])
    if k == 0 or k == len(x):
        return 0.0
    return float((x[k - 1] + x[k]) / 2)


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            words = (batch.column("text")[row].as_py() or "").encode().split()
            starts = np.arange(0, max(1, len(words) - WINDOW + STRIDE), STRIDE)
            rank = batch.column("rank")[row].as_py()
            if len(starts) > TRAIN_WINDOWS:
                starts = np.sort(np.random.default_rng(rank).choice(starts, TRAIN_WINDOWS, replace=False))
            cut = [b" ".join(words[a : a + WINDOW]) for a in starts.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([rank]), batch.column("toxic").slice(row, 1),
                 pa.array([cut], pa.list_(pa.binary()))],
                names=["rank", "toxic", "windows"])


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[Network, float] | None:
    """Learn from labelled rows that are not held out; None unless both classes are there.

    ``train_rows`` documents at most, half of each class, in the order of a hash of their
    ids; up to ``TRAIN_WINDOWS`` windows of each come to the driver.
    """
    rank = F.xxhash64(F.lit("toxicity"), "doc_id").bitwiseAND(F.lit((1 << 62) - 1))
    usable = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).withColumn("rank", rank))
    half = train_rows // 2
    picked = None
    for value in (0, 1):
        part = usable.where(F.col("toxic") == value).orderBy("rank", "doc_id").limit(half)
        picked = part if picked is None else picked.unionByName(part)
    # As many rows as the parameter says, whatever the corpus.
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    rows = texts.mapInArrow(
        _sample_windows, "rank long, toxic int, windows array<binary>").collect()
    rows.sort(key=lambda r: r["rank"])
    if len({r["toxic"] for r in rows}) < 2:
        return None
    return train(sample_of([[bytes(w) for w in r["windows"]] for r in rows], [r["toxic"] for r in rows]))


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = model.value
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                scores = np.zeros(batch.num_rows)
                if learned is not None:
                    net, cut = learned
                    texts = batch.column("text").cast(pa.binary()).to_pylist()
                    logits = np.clip(net.text_logits(texts) - cut, -500, 500)
                    scores = _sigmoid(logits)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                     pa.array((scores >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])

    return run


def score(docs: DataFrame, model: tuple[Network, float] | None) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Score 0 where the text is null or has no word, or nothing was learned.  Repeated rows
    get equal answers; a null id is not held out; other columns are not read; an empty
    table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    texts = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(
        _score(shared), "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Train on the labelled rows of ``docs`` and score every row of it."""
    return score(docs, fit(docs, labels, train_rows))
