"""Language identification in two steps: the family, then the language within it.

Texts become hashed counts of byte n-grams, square-rooted and scaled to length one.  A
linear support vector machine per family, each against the rest, picks the family.
Within a family, one machine per pair of its languages votes; votes tie-break by summed
margins.  The machines are trained on the driver from a bounded sample of labelled rows
(``TRAIN_DOCS`` documents in all, each with one short snippet of itself, so that short
texts are learned too); every row is scored where it lies, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import held_out, small_batches, unused

TRAIN_DOCS = 1600
MIN_DOCS_PER_LANGUAGE = 20
DIMENSIONS = 1 << 13
GRAM_LENGTHS = (1, 2, 3, 4)
PIECE_BYTES = 1 << 20
UNDETERMINED = "und"
SNIPPET_WORDS = (1, 12)

#: Language families by ISO 639-1 code.  Codes not listed are families of one.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fo af fy lb yi",
    "romance": "fr es pt it ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "hellenic": "el",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk tt",
    "semitic": "ar he mt am",
    "iranian": "fa ku ps tg",
    "indic": "hi bn mr ur pa gu ne si or as sa",
    "dravidian": "ta te kn ml",
    "sinitic": "zh",
    "japonic": "ja",
    "koreanic": "ko",
    "austronesian": "id ms tl jv mg",
}
_FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}

_KEEP_LETTERS = np.full(256, 32, dtype=np.uint8)
_KEEP_LETTERS[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_KEEP_LETTERS[128:] = np.arange(128, 256)


def family_of(language: str) -> str:
    return _FAMILY_OF.get(language.split("-")[0].split("_")[0].lower(), f"only {language}")


def gram_counts(texts: list[bytes]) -> np.ndarray:
    """Counts of hashed n-grams, one row per lower-cased UTF-8 text."""
    pad = b"    "
    joined = np.frombuffer(b"".join(b" " + t + pad for t in texts), dtype=np.uint8)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    sizes = lengths + 1 + len(pad)
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    inside = np.arange(len(joined)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    counted = inside <= np.repeat(lengths, sizes)
    letters = _KEEP_LETTERS[joined].astype(np.uint32)
    at = np.flatnonzero(counted)
    base = owner[at] * DIMENSIONS
    shift = np.uint32(32 - DIMENSIONS.bit_length() + 1)
    code = np.zeros(len(letters), dtype=np.uint32)
    found = []
    for n in range(1, max(GRAM_LENGTHS) + 1):
        code *= np.uint32(257)
        code[: len(code) - n + 1] += letters[n - 1 :]
        if n in GRAM_LENGTHS:
            mixed = code[at]
            mixed ^= np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)
            mixed *= np.uint32(0x85EBCA6B)
            mixed >>= shift
            found.append(base + mixed)
    total = np.bincount(np.concatenate(found), minlength=len(texts) * DIMENSIONS)
    return total.reshape(len(texts), DIMENSIONS)


def vectors(texts: list[bytes]) -> np.ndarray:
    """Unit vectors of whole texts; long ones are counted piece by piece."""
    counts = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and stop - start < 64 and (
            stop == start or size + len(texts[stop]) <= PIECE_BYTES // 8
        ):
            size += len(texts[stop])
            stop += 1
        if stop - start == 1:
            text = texts[start]
            for at in range(0, max(len(text), 1), PIECE_BYTES):
                counts[start] += gram_counts([text[at : at + PIECE_BYTES]])[0]
        else:
            counts[start:stop] = gram_counts(texts[start:stop])
        start = stop
    roots = np.sqrt(counts, out=counts)
    roots /= np.maximum(np.linalg.norm(roots, axis=1, keepdims=True), 1e-9)
    return roots


def train_svm(gram: np.ndarray, signs: np.ndarray, cost: float = 10.0, rounds: int = 40) -> np.ndarray:
    """Dual weights of a linear SVM with squared hinge loss, by coordinate descent."""
    signs = signs.astype(np.float64)
    # Both sides weigh the same, however many rows they have.
    weight = np.where(signs > 0, 0.5 / max((signs > 0).sum(), 1), 0.5 / max((signs < 0).sum(), 1))
    slack = 0.5 / (cost * weight * len(signs))
    alpha = np.zeros(len(signs))
    margins = np.zeros(len(signs))
    diagonal = gram.diagonal() + slack
    order = np.random.default_rng(5)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(signs)):
            slope = signs[i] * margins[i] - 1 + slack[i] * alpha[i]
            new = max(0.0, alpha[i] - slope / diagonal[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                margins += step * signs[i] * gram[i]
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return alpha * signs


@dataclass
class Model:
    """Families, their languages, and the machines between them."""

    families: list[str]
    languages: dict[str, list[str]]
    family_weights: np.ndarray
    pair_weights: dict[str, np.ndarray]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        one = np.ones((len(x), 1), dtype=np.float32)
        x = np.hstack([x, one])
        family_margin = x @ self.family_weights.T
        family_share = _softmax(2 * family_margin)
        chosen = family_margin.argmax(axis=1)
        names = np.empty(len(x), dtype=object)
        scores = np.zeros(len(x))
        for f, family in enumerate(self.families):
            rows = np.flatnonzero(chosen == f)
            languages = self.languages[family]
            share = np.ones((len(rows), len(languages)))
            winner = np.zeros(len(rows), dtype=np.int64)
            if len(languages) > 1 and len(rows):
                margins = x[rows] @ self.pair_weights[family].T
                votes = np.zeros((len(rows), len(languages)))
                sums = np.zeros((len(rows), len(languages)))
                for k, (a, b) in enumerate(combinations(range(len(languages)), 2)):
                    votes[:, a] += margins[:, k] >= 0
                    votes[:, b] += margins[:, k] < 0
                    sums[:, a] += margins[:, k]
                    sums[:, b] -= margins[:, k]
                share = _softmax(2 * sums / (len(languages) - 1))
                winner = (votes + 0.5 * np.tanh(sums / len(languages))).argmax(axis=1)
            names[rows] = [languages[w] for w in winner]
            scores[rows] = family_share[rows, f] * share[np.arange(len(rows)), winner]
        return names.tolist(), np.clip(scores, 0.0, 1.0)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(x: np.ndarray, labels: list[str]) -> Model:
    """Fit families and pairs on unit vectors with their languages."""
    one = np.ones((len(x), 1), dtype=np.float32)
    gram = (x @ x.T + 1).astype(np.float64)
    labels = np.array(labels, dtype=object)
    owner = np.array([family_of(v) for v in labels], dtype=object)
    families = sorted(set(owner))
    languages = {f: sorted(set(labels[owner == f])) for f in families}

    def machine(rows: np.ndarray, positive: np.ndarray) -> np.ndarray:
        dual = np.zeros(len(x), dtype=np.float32)
        dual[rows] = train_svm(gram[np.ix_(rows, rows)], np.where(positive, 1, -1))
        return np.concatenate([dual @ x, dual @ one])

    everyone = np.arange(len(x))
    family_weights = np.stack([
        machine(everyone, owner == f) if len(families) > 1
        else np.zeros(x.shape[1] + 1, np.float32)
        for f in families])
    pair_weights = {}
    for family, names in languages.items():
        pairs = []
        for a, b in combinations(names, 2):
            rows = np.flatnonzero((labels == a) | (labels == b))
            pairs.append(machine(rows, labels[rows] == a))
        pair_weights[family] = np.stack(pairs) if pairs else np.zeros((0, x.shape[1] + 1), np.float32)
    return Model(families, languages, family_weights, pair_weights)


def _lowered(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in pc.utf8_lower(column).cast(pa.binary()).to_pylist()]


def _sample_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            text = _lowered(one.column("text"))[0]
            words = text.split()
            rank = one.column("rank")[0].as_py()
            length = SNIPPET_WORDS[0] + rank % SNIPPET_WORDS[1]
            at = (rank // 64) % max(1, len(words) - length + 1)
            x = vectors([text, b" ".join(words[at : at + length])])
            where = [np.flatnonzero(v).astype(np.uint16) for v in x]
            yield pa.RecordBatch.from_arrays(
                [pa.array(one.column("lang").to_pylist() * 2), pa.array([rank] * 2, pa.int64()),
                 pa.array([w.tobytes() for w in where], pa.binary()),
                 pa.array([v[w].tobytes() for v, w in zip(x, where)], pa.binary())],
                names=["lang", "rank", "place", "value"])


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model | None:
    """Learn from rows with a language and a letter that are not held out.

    At most ``train_docs`` documents, the same number of each language, in the order of a
    hash of their ids; their vectors come to the driver.  Of more than
    ``train_docs / MIN_DOCS_PER_LANGUAGE`` languages, those with the most documents are
    learned.  None if there is nothing to learn from.
    """
    rank = F.xxhash64(F.lit("language"), "doc_id").bitwiseAND(F.lit((1 << 62) - 1))
    usable = docs.select("doc_id", "lang", "text", rank.alias("rank")).where(
        F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
    most = max(1, train_docs // MIN_DOCS_PER_LANGUAGE)
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n"))
              .orderBy(F.desc("n"), "lang").limit(most).collect()}
    if not counts:
        return None
    each = max(1, train_docs // len(counts))
    # A little more than needed by hash, then the first ones exactly.
    limits = F.create_map(*[
        F.lit(v) for lang, n in counts.items()
        for v in (lang, int(min(1.0, 2.0 * each / n) * (1 << 62)))])
    sample = usable.where(F.col("rank") < F.element_at(limits, F.col("lang")))
    rows = sample.mapInArrow(
        _sample_vectors, "lang string, rank long, place binary, value binary").collect()
    taken: dict[str, int] = {}
    places, labels = [], []
    for row in sorted(rows, key=lambda r: (r["rank"], r["lang"], len(r["place"]))):
        if taken.get(row["lang"], 0) >= each:
            continue
        taken[row["lang"]] = taken.get(row["lang"], 0) + 1
        places.append((np.frombuffer(row["place"], np.uint16), np.frombuffer(row["value"], np.float32)))
        labels.append(row["lang"])
    if not labels:
        return None
    x = np.zeros((len(labels), DIMENSIONS), dtype=np.float32)
    for k, (place, value) in enumerate(places):
        x[k, place] = value
    return train(x, labels)


def _judge(learned: Model | None, column: pa.Array, has_letter: list[bool]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; undetermined without a letter or a model."""
    names, scores = [UNDETERMINED] * len(column), np.zeros(len(column))
    if learned is None:
        return names, scores
    for at in range(0, len(column), 256):
        rows = [r for r in range(at, min(at + 256, len(column))) if has_letter[r]]
        if not rows:
            continue
        texts = _lowered(column.slice(at, 256))
        found, scores[rows] = learned.predict(vectors([texts[r - at] for r in rows]))
        for r, name in zip(rows, found):
            names[r] = name
    return names, scores


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = _judge(
                model.value, batch.column("text"), batch.column("has_letter").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"),
                 pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    ``und`` with score 0 where the text is null, has no letter, or nothing was learned.
    Repeated rows get equal answers; a null id is not held out; other columns are not
    read; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    texts = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("has_letter", F.col("text").rlike(r"\p{L}"))
    return texts.mapInArrow(
        _predict(shared), "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Train on ``docs`` and predict every row of it."""
    return predict(docs, fit(docs, train_docs))


def accepted(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``docs`` without the rows whose language cannot be told: those without a letter.

    Rows are judged where they lie and pass with all of their columns.  The machines name
    a language for every text with a letter, so they reject none; where there was nothing
    to learn from, the letter alone decides.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, train_docs))
    mark = unused("has_letter", docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has_letter = batch.column(mark).to_pylist()
            told = has_letter
            if shared.value is not None:
                names, _ = _judge(shared.value, batch.column("text"), has_letter)
                told = [name != UNDETERMINED for name in names]
            yield batch.filter(pa.array(told, pa.bool_())).drop_columns([mark])

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return small_batches(docs).withColumn(mark, letters).mapInArrow(run, docs.schema)
