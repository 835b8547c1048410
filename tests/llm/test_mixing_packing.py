import zlib

import numpy as np
import public_tokenizers
import pytest
from odd_rows import ODD
from tokenizers import Tokenizer

from tallystar.llm import mixing, packing


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Reshare by weight, round after round, until no one is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s] + 1e-9]
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}


def test_mix_meets_targets(spark, make_docs, corpus):
    rows = corpus + [(10_000 + k, "w " * 5, "en", "tiny") for k in range(3)]
    plan = mixing.mix_plan(make_docs(rows)).collect()
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    want = brute_targets(sizes)
    longest, taken = {}, {}
    for r in plan:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        longest[r["source"]] = max(longest.get(r["source"], 0), r["size"])
    for source, words in taken.items():
        assert abs(words - want[source]) <= longest[source] + 1
    again = mixing.mix_plan(make_docs(list(reversed(rows)))).collect()
    assert sorted(map(tuple, plan)) == sorted(map(tuple, again))


def test_mix_odd_rows(spark, make_docs):
    plan = mixing.mix_plan(make_docs(ODD)).collect()
    assert len(plan) == len(ODD)
    assert {r["size"] for r in plan if r["doc_id"] in (1, 2, 3)} == {0}
    mixed = mixing.mixed(make_docs(ODD))
    assert mixed.columns == make_docs(ODD).columns
    assert sum(len((r["text"] or "").split()) for r in mixed.collect()) == sum(r["taken"] for r in plan)
    assert mixing.mix_plan(make_docs([])).count() == 0
    assert mixing.mixed(make_docs([])).count() == 0


def check_packing(rows, pieces):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = []
    for doc_id, text, *_ in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want.append((doc_id, k, at, len(part), zlib.crc32(part.tobytes())))
    got = [(p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    bins = {}
    for p in pieces:
        bins.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 4096
    return len(bins), sum(p["length"] for p in pieces)


def test_packing_round_trip(spark, make_docs, corpus):
    bins, tokens = check_packing(corpus, packing.pack(make_docs(corpus)).collect())
    assert bins <= 1.03 * tokens / 4096 + 1


def test_packing_odd_rows(spark, make_docs):
    odd = ODD + [(20, "it's <|endoftext|> I'LL don't é́ ΑΣ İ", "en", "a"), (21, "<|ENDOFTEXT|> x'", "en", "a")]
    check_packing(odd, packing.pack(make_docs(odd)).collect())
    assert packing.pack(make_docs([])).count() == 0


def test_bounded_space_closes_the_fullest():
    fit = packing.BestFit(capacity=10, open_bins=2)
    assert [fit.place(n) for n in (6, 7, 8, 4, 3)] == [(0, 0), (1, 0), (2, 0), (0, 6), (3, 0)]
    assert fit.n_open == 2
