import collections
import math
import re

import duckdb
import numpy as np
import pytest
from odd_rows import ODD
from pyspark.sql import functions as F

from tallystar.llm import license_scan, quality_rules, queries, url_filter

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    triples = list(zip(words, words[1:], words[2:]))
    often = collections.Counter(triples)
    covered = {k + d for k, t in enumerate(triples) if often[t] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def brute_verdicts(rows):
    """Estimates by matrices, of each language and source and of each language, then drawn."""
    floors = np.array(list(quality_rules.FLOORS.values()))
    counts = [brute_counts(r[1]) for r in rows]
    x = np.array([
        (math.log1p(n), math.log1p(c / max(n, 1)), math.sqrt(s / max(n, 1)), math.log1p(d), math.sqrt(w / max(n, 1)))
        for n, c, s, d, w in counts])
    groups = [(r[2], r[3]) for r in rows]

    def moments(y):
        mu = y.mean(axis=0)
        cov = (y[:, :, None] * y[:, None, :]).mean(axis=0) - np.outer(mu, mu)
        cov[np.diag_indices(5)] = np.maximum(np.diag(cov), 0) + floors**2
        return mu, cov

    def distances(y, mu, cov):
        return np.einsum("ni,ij,nj->n", y - mu, np.linalg.inv(cov), y - mu)

    members = {g: [k for k, h in enumerate(groups) if h == g] for g in set(groups)}
    members |= {lang: [k for k, h in enumerate(groups) if h[0] == lang] for lang, _ in set(groups)}
    state = {}
    for g, ids in members.items():
        y = x[ids]
        q = np.quantile(y, [0.25, 0.5, 0.75], axis=0, method="inverted_cdf")
        near = (np.abs(y - q[1]) <= np.maximum(q[2] - q[0], 2 * floors)).all(axis=1)
        state[g] = moments(y[near] if near.any() else y)
    total = sum(np.linalg.slogdet(c)[1] for _, c in state.values())
    for _ in range(quality_rules.STEPS):
        better = {}
        for g, ids in members.items():
            d = distances(x[ids], *state[g])
            bins = np.floor(np.log2(np.maximum(d, 1e-9)) * quality_rules.BINS_PER_DOUBLING)
            cut = np.sort(bins)[math.ceil(len(ids) * quality_rules.COVERED) - 1]
            better[g] = moments(x[ids][bins <= cut])
        now = sum(np.linalg.slogdet(c)[1] for _, c in better.values())
        if now > total - 1e-9:
            break
        state, total = better, now
    drawn = {}
    for g in set(groups):
        weight = len(members[g]) / (len(members[g]) + quality_rules.PRIOR_ROWS)
        drawn[g] = tuple(weight * a + (1 - weight) * b for a, b in zip(state[g], state[g[0]]))
    scale = quality_rules.COVERED / quality_rules._chi2(7, quality_rules.chi2_quantile(5, quality_rules.COVERED))
    limit = quality_rules.chi2_quantile(5, 1 - quality_rules.TAIL)
    out = []
    for r, c, y, g in zip(rows, counts, x, groups):
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        far = distances(y[None], *drawn[g])[0] / scale
        out.append((r[0], *c, failed, not failed and far <= limit, far))
    return out


def test_quality_against_brute_force(spark, make_docs, corpus):
    rows = [(k, t, lang, f"s{k % 2}") for k, (_, t, lang, _) in enumerate(corpus)]
    found = sorted(map(tuple, quality_rules.assess(make_docs(rows)).collect()))
    want = sorted(brute_verdicts(rows))
    assert [f[:8] for f in found] == [w[:8] for w in want]
    assert np.allclose([f[8] for f in found], [w[8] for w in want], rtol=1e-6)
    assert sum(f[7] for f in found) > 0.6 * len(found)


def test_many_groups_are_joined_with_the_same_verdicts(make_docs, corpus, monkeypatch):
    rows = [(k, t, lang, f"s{k % 2}") for k, (_, t, lang, _) in enumerate(corpus[:60])]
    near = {r["doc_id"]: r for r in quality_rules.assess(make_docs(rows)).collect()}
    monkeypatch.setattr(quality_rules, "BROADCAST_GROUPS", 1)
    for r in quality_rules.assess(make_docs(rows)).collect():
        assert r[:8] == near[r["doc_id"]][:8]
        assert np.isclose(r["distance"], near[r["doc_id"]]["distance"], rtol=1e-6)


def test_quality_of_odd_rows(spark, make_docs):
    found = quality_rules.assess(make_docs(ODD)).collect()
    assert len(found) == len(ODD)
    texts = {r[0]: r[1] for r in ODD}
    for r in found:
        assert tuple(r)[1:6] == brute_counts(texts[r["doc_id"]])
        assert not r["kept"] or not r["base_failed"]
    assert quality_rules.assess(make_docs([])).count() == 0


def test_small_groups_are_not_judged_by_another_language(make_docs, corpus, monkeypatch):
    mcd = quality_rules.mcd
    monkeypatch.setattr(quality_rules, "mcd", lambda rows, covered: mcd(rows, covered, steps=0))
    texts = [t for _, t, lang, _ in corpus if lang == "en" and t][:40]
    own = [(k, t, "en", f"s{k % 3}") for k, t in enumerate(texts)]
    alone = {r["doc_id"]: r["distance"] for r in quality_rules.assess(make_docs(own)).collect()}
    more = own + [(100 + k, " ".join(3 * w for w in t.split()), "xx", "s0") for k, t in enumerate(texts[:30])]
    found = {r["doc_id"]: r["distance"] for r in quality_rules.assess(make_docs(more)).collect()}
    assert len(found) == len(more)
    assert np.allclose([found[k] for k in alone], list(alone.values()), rtol=1e-6)


def test_drawn_estimate_weighs_rows(spark, make_docs, corpus):
    rows = [(k, t, "en", f"s{k % 2}") for k, (_, t, lang, _) in enumerate(corpus) if lang == "en"]
    counts = quality_rules._transformed(quality_rules.text_counts(make_docs(rows)))
    both = counts.select(F.explode(F.array("source", "lang")).alias("group"), *quality_rules.DIMENSIONS)
    plain = quality_rules.mcd(quality_rules.stored(both), steps=0)
    parents = spark.createDataFrame([("s0", "en", 60), ("s1", "en", 0)], "group string, parent string, n long")
    of = lambda frame: {r["group"]: r.asDict() for r in frame.collect()}
    before, after = of(plain), of(quality_rules._drawn(plain, parents, 20))

    def parts(row):
        low = np.array([[row.get(f"l{i}{j}", 0.0) for j in range(5)] for i in range(5)])
        return np.array([row[f"mu{i}"] for i in range(5)]), low @ low.T

    for group, weight in (("s0", 0.75), ("s1", 0.0)):
        for got, own, lang in zip(parts(after[group]), parts(before[group]), parts(before["en"])):
            assert np.allclose(got, weight * own + (1 - weight) * lang)


def test_chi_square():
    assert quality_rules._chi2(4, 4) == pytest.approx(1 - math.exp(-2) * 3, rel=1e-12)
    assert 1 - quality_rules._chi2(4, 60) == pytest.approx(math.exp(-30) * 31, rel=1e-3)
    assert quality_rules.chi2_quantile(5, 0.75) == pytest.approx(6.6257, abs=1e-3)


def sql_rows(sql, **tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame)
    return sorted((tuple(r) for r in con.sql(sql).fetchall()), key=repr)


LICENCES = [
    "Released under\nthe MIT-License. More", "UNDER the mit LICENSE under the mit license",
    "Apache License, Version 2.0; apache license version 2", "cc by nc", "CC  BY-NC 4.0 cc-by_nc", "mit license",
    "This work is licensed under the GNU General Public License, version 3.",
    "work licensed under gnu general public license version 3 this", "ALL RIGHTS (c) RESERVED", "underthemitlicense",
    "pad " * 70 + "under the mit license" + " pad" * 70, "K under the mıt license", None, "",
    "redistribution and use in source and binary forms with or without modification are permitted provided",
]


def test_license_scan_against_every_block(spark, make_docs):
    rows = [(k, t) for k, t in enumerate(LICENCES)] + [r[:2] for r in ODD if r[0] not in (None, 5)]
    rows = list({k + 100 * (j >= len(LICENCES)): (k + 100 * (j >= len(LICENCES)), t)
                 for j, (k, t) in enumerate(rows)}.values())
    docs = make_docs(rows)
    found = license_scan.scan(docs)
    want = sql_rows(queries.ORACLES["op2_license_scan"], documents=docs.toPandas())
    assert sorted((tuple(r) for r in found.collect()), key=repr) == want
    labels = {r["doc_id"]: r["labels"] for r in found.collect()}
    assert labels[0] == "mit" and labels[6] == labels[7] == "gpl" and labels[5] == "" and labels[9] == ""
    assert license_scan.scan(make_docs([])).count() == 0


def test_license_found_wherever_its_block_starts(spark, make_docs):
    """A notice with a foreign word between each two fills a block, and stands anywhere."""
    notice = next(t for t, label in license_scan.NOTICES if label == "mit").split()
    spread = " ".join(f"{w} foreign{k}" for k, w in enumerate(notice))
    rows = [(k, "pad " * k * 3 + spread) for k in range(20)]
    found = license_scan.scan(make_docs(rows)).collect()
    assert {r["labels"] for r in found} == {"mit"} and len({r["score"] for r in found}) == 1


def test_license_scan_answers_every_row(spark, make_docs):
    rows = [(None, "all rights reserved"), (None, "cc by nc"), (None, None), (7, "one two"),
            (7, "under the mit license"), (7, "under the mit license")]
    found = license_scan.scan(make_docs(rows)).select("doc_id", "n_words", "n_base", "labels")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([
        (None, 3, 0, "all-rights-reserved"), (None, 3, 1, "cc-by-nc"), (None, 0, 0, ""), (7, 2, 0, ""),
        (7, 4, 1, "mit"), (7, 4, 1, "mit")], key=repr)


def test_license_prefix_filter_is_exact(spark, make_docs, corpus):
    """Templates of common words: many candidates, all thresholds."""
    common = [w for w, _ in collections.Counter(
        w for r in corpus for w in re.findall("[a-z]+", r[1].lower())).most_common(24)]
    notices = [(" ".join(common[k : k + 8]), f"n{k}") for k in range(0, 16, 4)]
    rows = corpus[:50]
    width = license_scan.block_words(notices)
    for threshold in (0.6, 0.8, 1.0):
        found = license_scan.scan(make_docs(rows), phrases=(), notices=notices, threshold=threshold)
        for r in found.collect():
            text = next(t for k, t, *_ in rows if k == r["doc_id"])
            words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()) if w]
            hit = {}
            for at in range(max(len(words), 1)):
                block = set(words[at : at + width])
                for wording, label in notices:
                    share = len(block & set(wording.split())) / len(set(wording.split()))
                    if share >= threshold - 1e-9:
                        hit[label] = max(hit.get(label, 0), share)
            assert r["labels"] == ",".join(sorted(hit)) and r["n_words"] == len(words)
            assert r["score"] == pytest.approx(max(hit.values(), default=0))


def brute_active(entries, hosts, at):
    found = set()
    for pattern in hosts:
        for category in {e[1] for e in entries if e[0] == pattern}:
            log = sorted((t, a) for p, c, t, a in entries if (p, c) == (pattern, category) and t is not None
                         and a in ("add", "remove") and t <= at)
            if log and log[-1][1] == "add":
                found.add((pattern, category))
    return found


@pytest.mark.parametrize("period", [7, 50, 10_000])
def test_urls_as_of_their_fetch(spark, period):
    draw = np.random.default_rng(period)
    patterns = ["a.example", "b.a.example", "c.example", "example", "d.e.f.example"]
    entries = [(str(draw.choice(patterns)), str(draw.choice(["spam", "adult"])), int(draw.integers(0, 200)),
                str(draw.choice(["add", "remove"]))) for _ in range(60)]
    entries += [("a.example", "spam", 20, "add"), ("a.example", "spam", 20, "remove"), (None, "spam", 3, "add"),
                ("c.example", "spam", None, "add"), ("c.example", None, 5, "add"), ("c.example", "spam", 1, "other")]
    urls = ["http://b.a.example/x", "https://u@C.example:80/y?z", "http://x.d.e.f.example.#q", "not a url", None,
            "http://other.test/", "http://notexample/"]
    captures = [(k, urls[k % len(urls)], int(draw.integers(0, 220)) if k % 11 else None, "clash") for k in range(90)]
    captures.append(captures[0])
    frame = spark.createDataFrame(captures, "page_id long, url string, fetched_at long, pattern string")
    log = spark.createDataFrame(entries, "pattern string, category string, listed_at long, action string")
    found = {r["page_id"]: r for r in url_filter.evaluate(frame, log, period).collect()}
    assert len(found) == 90
    hosts = {urls[0]: "b.a.example", urls[1]: "c.example", urls[2]: "x.d.e.f.example", urls[5]: "other.test",
             urls[6]: "notexample"}
    for k, url, at, _ in captures:
        host = hosts.get(url)
        labels = host.split(".") if host else []
        parents = [".".join(labels[i:]) for i in range(len(labels))]
        active = brute_active(entries, parents, at) if host and at is not None else set()
        r = found[k]
        assert (r["host"], r["blocked"]) == (host, bool(active))
        assert r["categories"] == ",".join(sorted({c for _, c in active if c}))
        assert r["matched"] == max((p for p, _ in active), key=len, default=None)


def test_urls_without_captures_or_entries(spark):
    none = spark.createDataFrame([], "page_id long, url string, fetched_at long")
    log = spark.createDataFrame([], "pattern string, category string, listed_at long, action string")
    assert url_filter.evaluate(none, log).count() == 0
    one = spark.createDataFrame([(1, "http://a.b/", 5)], none.schema)
    assert [r["blocked"] for r in url_filter.evaluate(one, log).collect()] == [False]
