"""Line dedup and source divergence against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd_rows import ODD

from tallystar.llm import line_dedup, source_divergence

BLANK = " \t\n\x0b\x0c\r"


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_lines(rows):
    """Rows as documents of their own; a null id is less than any other."""
    low = float("-inf")
    holders = defaultdict(set)
    for k, (_, text, *_) in enumerate(rows):
        for line in (text or "").split("\n"):
            holders[fold(line.strip(BLANK))].add(k)
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            key = fold(line.strip(BLANK))
            most = max(low if rows[k][0] is None else rows[k][0] for k in holders[key])
            mine = low if doc_id is None else doc_id
            if len(key) < 20 or len(holders[key]) < 3 or mine == most:
                kept.append(line)
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((doc_id, len(lines), len(lines) - len(kept), digest))
    return sorted(out, key=repr)


LONG = "A Line That Many Documents Repeat"
LINES = [
    (20, f"{LONG}\nown first\n  {LONG.lower()}\t\n"), (21, LONG.upper()), (22, f"x\n{LONG}"),
    (22, f"x\n{LONG}"), (None, f"{LONG}\r"), (23, "ÉÉÉÉ ÉÉÉÉ ÉÉÉÉ ÉÉÉ"), (24, "ÉÉÉÉ ÉÉÉÉ ÉÉÉÉ ÉÉÉ"),
    (25, "ÉÉÉÉ ÉÉÉÉ ÉÉÉÉ ÉÉÉ"), (26, "É" * 20), (27, "É" * 20), (28, "É" * 20), (29, "é" * 20),
    (30, "\n".join([LONG] * 3)), (None, "only unnamed rows hold this"), (None, "only unnamed rows hold this"),
    (None, "Only unnamed rows hold this"), (31, "\n\n\n"), (32, "short\nshort"), (33, "short"), (34, "short"),
]


@pytest.mark.parametrize("frequent", [100_000, 3])
def test_lines_against_brute_force(spark, make_docs, corpus, frequent):
    rows = LINES + ODD + list(corpus)
    found = line_dedup.without_repeated_lines(make_docs(rows), frequent=frequent).collect()
    answer = [
        (r["row"]["doc_id"], r["n_lines"], r["n_dropped"],
         hashlib.sha256((r["kept_text"] or "").encode()).hexdigest()) for r in found]
    assert sorted(answer, key=repr) == brute_lines(rows)
    assert sum(r["n_dropped"] for r in found) > 20
    assert all(r["kept_text"] == r["row"]["text"] for r in found if not r["n_dropped"])


def test_lines_keep_columns_of_any_name(spark, make_docs):
    docs = make_docs(LINES).selectExpr(
        "*", "1 gone", "2 mark", "3 pos", "4 keeper", "5 row", "6 n", "7 high", "8 low", "9 first",
        "10 kept_text", "11 gone_id", "12 n_lines")
    out = line_dedup.without_repeated_lines(docs)
    assert out.schema["row"].dataType.names == docs.columns
    assert [r["row"]["kept_text"] for r in out.collect()] == [10] * len(LINES)
    assert line_dedup.without_repeated_lines(make_docs([])).count() == 0


def brute_audit(rows, term_ranks=200):
    groups, grams, holders = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", fold(text or ""))
        group = (lang or "", source or "")
        groups[group].update(words)
        grams[group[0]].update(words)
        holders[group[0]].update(set(words))
    kept = {g: [w for w in c if holders[g][w] >= 3] for g, c in grams.items()}

    def shares(counts, words):
        whole = sum(counts[w] for w in words) + len(words)
        return {w: 1 + 10**9 * (counts[w] + 1) // whole for w in words}

    p = {g: shares(c, kept[g[0]]) for g, c in groups.items()}
    q = {g: shares(c, kept[g]) for g, c in grams.items()}
    out = []
    for (lang, source), mine in p.items():
        pairs = [
            (-sum((mine[w] - theirs[w]) ** 2 // theirs[w] for w in mine), other.encode())
            for (its, other), theirs in p.items() if its == lang and other != source]
        terms = [
            (-((mine[w] - q[lang][w]) ** 2 // q[lang][w]), w.encode())
            for w in mine if groups[lang, source][w] and mine[w] > q[lang][w]]
        for part, found in (("pair", pairs), ("term", sorted(terms)[:term_ranks])):
            out += [(lang, source, part, item.decode(), -v, k) for k, (v, item) in enumerate(sorted(found), 1)]
    return sorted(out)


TERMS = [
    (k, text, lang, source) for k, (text, lang, source) in enumerate([
        ("Alpha beta GAMMA", "xx", "a"), ("alpha beta", "xx", "b"), ("alpha gamma_beta", "xx", "c"),
        ("alpha", "xx", "c"), ("12 34", "xx", "no terms"), (None, "xx", None), ("beta Ünï", "xx", ""),
        ("ünÏ Alpha", None, "s"), ("nothing kept", "yy", "a"), ("here either", "yy", "b"), ("alone", "zz", "a"),
        ("Ünï İK", "xx", "a"), ("Ünï", "xx", "é"), ("Ünï", "xx", "z"),
    ])]


@pytest.mark.parametrize("block, chunk", [(1 << 12, 32), (300, 3)])
def test_audit_against_brute_force(spark, make_docs, corpus, block, chunk):
    rows = TERMS + [(r[0], r[1], r[2], r[3]) for r in list(corpus) + ODD]
    docs = spark.createDataFrame(
        [(*r, 1, 2) for r in rows], "doc_id long, text string, lang string, source string, term int, p int")
    found = source_divergence.audit(docs, block=block, chunk=chunk)
    assert sorted(map(tuple, found.collect())) == brute_audit(rows)


def test_audit_of_little(spark, make_docs):
    assert source_divergence.audit(make_docs([])).count() == 0
    found = source_divergence.audit(make_docs([(1, "a b", "en", "s"), (2, None, "en", "t")]))
    assert sorted(map(tuple, found.collect())) == [
        ("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_audit_hands_terms_on_early(monkeypatch, corpus):
    import pyarrow as pa
    monkeypatch.setattr(source_divergence, "HELD_TERMS", 50)
    batch = pa.RecordBatch.from_pylist(
        [{"lang": r[2] or "", "source": r[3] or "", "text": r[1] or ""} for r in corpus])
    parts = [b.to_pylist() for b in source_divergence._counts([batch])]
    assert len(parts) > 10
    total = Counter()
    for row in (r for part in parts for r in part):
        total[row["term"]] += row["count"]
    assert total == Counter(
        w for r in corpus for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", fold(r[1] or "")))


def test_gallop_finds_what_sets_share():
    rng = np.random.default_rng(5)
    for few, many in [(0, 10), (10, 0), (3, 5000), (700, 800), (5000, 5000)]:
        a = np.sort(rng.choice(9000, few, replace=False))
        b = np.sort(rng.choice(9000, many, replace=False))
        in_a, in_b = source_divergence.gallop(a, b, run=64)
        assert (a[in_a] == b[in_b]).all()
        assert set(a[in_a].tolist()) == set(a.tolist()) & set(b.tolist())


def test_shares_do_not_overflow(spark):
    counts = np.array([0, 7, 10**13, 4 * 10**14])
    whole = 4 * 10**14 + 12345
    want = [1 + 10**9 * (int(c) + 1) // whole for c in counts]
    assert source_divergence.shares(counts, whole).tolist() == want
    frame = spark.createDataFrame([(int(c), whole) for c in counts], "c long, w long")
    found = frame.select("c", source_divergence.share(frame["c"], frame["w"]).alias("p")).orderBy("c").collect()
    assert [r["p"] for r in found] == want
