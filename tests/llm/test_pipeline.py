"""Every stage against brute force on its own input, and the whole run against the stages."""

import re
from collections import Counter

import pytest
from odd_rows import ODD
from test_dedup import SPACES, brute_components, brute_print
from test_mixing_packing import brute_targets, check_packing

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The smallest documents with odd rows, through all stages; rows after each."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    # Odd ids beyond the table's own, so that they are documents of their own.
    odd = [(None if r[0] is None else 10_000 + r[0], r[1], r[2], r[3], len(r[1] or "")) for r in ODD]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    folder = tmp_path_factory.mktemp("stages")
    rows, frames = [docs.collect()], []
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SMALL)
        result.write.parquet(f"{folder}/{name}")
        frames.append(result.columns)
        docs = spark.read.parquet(f"{folder}/{name}")
        rows.append(docs.collect())
    return rows, frames


def test_columns(stages):
    _, columns = stages
    assert len(columns) == 5
    assert all(c == ["doc_id", "text", "lang", "source", "n_chars"] for c in columns[:-1])


def test_only_texts_without_letters_go(stages):
    before, after = stages[0][0], stages[0][1]
    want = Counter(map(tuple, (r for r in before if re.search(r"[^\W\d_]", r["text"] or ""))))
    assert Counter(map(tuple, after)) == want


def test_one_of_each_text_stays(stages):
    before, after = stages[0][1], stages[0][2]
    least = {}
    for r in sorted(before, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)):
        least.setdefault(SPACES.sub(" ", r["text"] or ""), r["doc_id"])
    assert Counter(r["doc_id"] for r in after) == Counter(least.values())


def test_one_of_each_group_stays(stages):
    before, after = stages[0][2], stages[0][3]
    roots = brute_components([brute_print(r["text"]) for r in before])
    least = {}
    for r, root in zip(before, roots):
        ids = [i for i in (least.get(root), r["doc_id"]) if i is not None]
        least[root] = min(ids, default=None)
    assert Counter(r["doc_id"] for r in after) == Counter(least.values())


def test_sources_meet_their_targets(stages):
    before, after = stages[0][3], stages[0][4]
    size = lambda r: len((r["text"] or "").split())
    sizes, taken, longest = Counter(), Counter(), Counter()
    for r in before:
        sizes[r["source"]] += size(r)
        longest[r["source"]] = max(longest[r["source"]], size(r))
    for r in after:
        taken[r["source"]] += size(r)
    assert max(Counter(r["doc_id"] for r in after).values()) <= 3
    for source, target in brute_targets(dict(sizes)).items():
        assert abs(taken[source] - target) <= longest[source] + 1


def test_packing_is_whole(stages):
    before, after = stages[0][4], stages[0][5]
    check_packing([tuple(r) for r in before], after)


def test_run_is_the_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = Counter(map(tuple, corpus_pipeline.run(spark, SMALL).select(columns).collect()))
    assert whole == Counter(map(tuple, docs.select(columns).collect()))
    assert corpus_pipeline.ORACLE_SQL is None
