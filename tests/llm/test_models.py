import zlib

import numpy as np
import pytest
from odd_rows import ODD

from tallystar.llm import language_id, toxicity

SMALL = "/root/testdata/sf0.01"


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()


def test_languages_of_held_out_documents(spark, table):
    truth = {r["doc_id"]: r["lang"] for r in table.select("doc_id", "lang").collect()}
    found = language_id.identify(table).collect()
    assert len(found) == len(truth)
    right = [r["lang_pred"] == truth[r["doc_id"]] for r in found if r["held_out"]]
    assert np.mean(right) > 0.95
    assert all(r["held_out"] == is_held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in found)


def test_held_out_labels_are_never_learned(spark, make_docs, corpus):
    lied = [(i, t, "xx" if is_held_out(i) else lang, s) for i, t, lang, s in corpus]
    found = language_id.identify(make_docs(lied))
    assert "xx" not in {r["lang_pred"] for r in found.collect()}


def test_labels_of_held_out_rows_change_nothing(spark, make_docs, corpus):
    lied = [(i, t, "xx" if is_held_out(i) else lang, s) for i, t, lang, s in corpus]
    bare = [(i, t, None if is_held_out(i) else lang, s) for i, t, lang, s in corpus]
    one, other = (sorted(map(tuple, language_id.identify(make_docs(rows)).collect())) for rows in (lied, bare))
    assert one == other


def test_the_bound_on_training_holds_for_any_number_of_languages(spark, make_docs, monkeypatch):
    rows = [(k, f"word{k % 300} and some more of it {k}", f"l{k % 300:03d}" if k % 3 else "l000", "s")
            for k in range(1500)]
    seen = []
    train = language_id.train
    monkeypatch.setattr(language_id, "train", lambda x, labels: seen.append(labels) or train(x, labels))
    assert language_id.fit(make_docs(rows), train_docs=100) is not None
    labels, = seen
    assert len(labels) <= 100
    assert len(set(labels)) <= 100 // language_id.MIN_DOCS_PER_LANGUAGE
    assert "l000" in labels


def test_languages_of_odd_rows(spark, make_docs, corpus):
    docs = make_docs(corpus + ODD + [(900, "... 123 %%%", "en", "s")])
    model = language_id.fit(docs)
    found = {r["doc_id"]: r for r in language_id.predict(make_docs(ODD), model).collect()}
    assert found[1]["lang_pred"] == found[2]["lang_pred"] == found[8]["lang_pred"] == "und"
    assert found[1]["score"] == 0 and found[None]["held_out"] is False
    assert found[7]["lang_pred"] != "und" and found[9]["lang_pred"] != "und"
    left = language_id.accepted(docs)
    assert left.schema == docs.schema
    assert {r["doc_id"] for r in left.collect()} >= {4, 6, 7, 9}
    assert 900 not in {r["doc_id"] for r in left.collect()}


def test_nothing_to_learn_languages_from(spark, make_docs):
    unlabelled = make_docs([(1, "some words", None, "s"), (2, "more", None, "s")])
    assert {r["lang_pred"] for r in language_id.identify(unlabelled).collect()} == {"und"}
    assert language_id.identify(make_docs([])).count() == 0
    one = make_docs([(k, f"only one language {k}", "pt", "s") for k in range(9)])
    assert {r["lang_pred"] for r in language_id.identify(one).collect()} == {"pt"}


def test_families_first():
    assert language_id.family_of("pt-BR") == language_id.family_of("fr") == "romance"
    assert language_id.family_of("tlh") == "only tlh"


def test_svm_separates():
    draw = np.random.default_rng(0)
    x = np.vstack([draw.normal(1, 0.3, (30, 4)), draw.normal(-1, 0.3, (30, 4))])
    signs = np.array([1] * 30 + [-1] * 30)
    dual = language_id.train_svm(x @ x.T + 1, signs)
    assert (np.sign(x @ (dual @ x) + dual.sum()) == signs).all()


def test_long_text_counts_like_its_pieces(monkeypatch):
    text = b"some words of a long text " * 400
    whole = language_id.vectors([text])
    monkeypatch.setattr(language_id, "PIECE_BYTES", 1000)
    assert np.abs(language_id.vectors([text]) - whole).max() < 0.05


INSULTS = ("snarfle", "grobnik", "zwexel")


def toxic_corpus(n=240, seed=1):
    draw = np.random.default_rng(seed)
    rows, labels = [], []
    for k in range(n):
        words = ["".join(draw.choice(list("aeiourtnsl"), draw.integers(2, 7))) for _ in range(int(draw.integers(3, 90)))]
        bad = k % 3 == 0
        if bad:
            for _ in range(2):
                words.insert(int(draw.integers(0, len(words) + 1)), str(draw.choice(INSULTS)))
        rows.append((k, " ".join(words), "en", "s"))
        labels.append((k, 1, int(bad)))
    return rows, labels


def test_toxicity_of_held_out_documents(spark, make_docs):
    rows, labels = toxic_corpus()
    table = spark.createDataFrame(labels + [(None, 1, 1), (5000, None, None)], "doc_id long, quality int, toxic int")
    truth = {k: t for k, _, t in labels}
    # A label that may not be learned says the opposite.
    table = table.union(spark.createDataFrame(
        [(k, 1, 1 - t) for k, _, t in labels if is_held_out(k)], table.schema))
    docs = make_docs(rows + [(700, None), (701, ""), (702, "... !!"), (703, " ".join(["tara"] * 5000 + ["grobnik"] * 2 + ["sola"] * 5000))])
    found = {r["doc_id"]: r for r in toxicity.toxicity(docs, table).collect()}
    assert len(found) == len(rows) + 4
    held = [k for k in truth if is_held_out(k)]
    assert np.mean([found[k]["predicted"] == truth[k] for k in held]) > 0.9
    assert all(found[k]["score"] == 0 and found[k]["predicted"] == 0 for k in (700, 701, 702))
    assert found[703]["predicted"] == 1  # one bad window in a long text
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    assert all(r["held_out"] == is_held_out(k) for k, r in found.items())


def test_nothing_to_learn_toxicity_from(spark, make_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    docs = make_docs([(1, "a b"), (2, "c d"), (2, "c d"), (None, "x")])
    assert [r["score"] for r in toxicity.toxicity(docs, labels).collect()] == [0.0] * 4
    assert toxicity.toxicity(make_docs([]), labels.limit(0)).count() == 0


def test_gradients():
    texts = [b"some words that are read here", b"and others, again and again", b"x"]
    words = toxicity.read_words(texts)
    first, count, _ = toxicity.windows_of(words.text_begin)
    net = toxicity.Network.fresh(2)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        out = net.forward(words, first, count)
        return np.mean(np.log1p(np.exp(out)) - y * out)

    out, tape = net.forward(words, first, count, keep=True)
    gradients = net.backward(words, tape, (toxicity._sigmoid(out) - y) / 3)
    for name, place in (("hf", (1, 3)), ("hb", (2, 20)), ("xf", (0, 5)), ("wa", (3, 3)), ("va", (2,)),
                        ("wo", (1,)), ("cb", (4,)), ("word", (int(words.word[2]), 1)),
                        ("head", (int(words.head[1]), 2)), ("gram", (int(words.gram[4]), 0))):
        kept, step = net.p[name][place], 1e-4
        net.p[name][place] = kept + step
        up = loss()
        net.p[name][place] = kept - step
        down = loss()
        net.p[name][place] = kept
        assert gradients[name][place] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=2e-6), name


def test_all_windows_overlap():
    begin = np.array([0, 0, 5, 5 + 32, 37 + 33, 70 + 100])
    first, count, text = toxicity.windows_of(begin)
    for t in range(5):
        seen = set()
        for f, n, owner in zip(first, count, text):
            if owner == t:
                assert begin[t] <= f and f + n <= begin[t + 1] and n <= toxicity.WINDOW
                seen |= set(range(f, f + n))
        assert seen == set(range(begin[t], begin[t + 1]))


def test_nothing_to_learn_rejects_no_letter(make_docs):
    rows = [(1, "a clean text", None), (2, "ein Satz", None), (3, "123 ...", None), (4, None, None), (None, "é", None)]
    assert language_id.fit(make_docs(rows)) is None
    left = language_id.accepted(make_docs(rows)).collect()
    assert sorted((r["text"] for r in left)) == ["a clean text", "ein Satz", "é"]
