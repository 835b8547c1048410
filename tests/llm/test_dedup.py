import hashlib
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from odd_rows import ODD
from pyspark.sql import functions as F

from tallystar.llm import components, exact_dedup, simhash, suffix_dedup

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def brute_exact(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(SPACES.sub(" ", text or ""), []).append(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        body = SPACES.sub(" ", text or "")
        ids = groups[body]
        keep = min(ids, key=lambda i: (i is None, i))
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=repr)


def as_tuples(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_exact_groups(spark, make_docs, corpus):
    rows = corpus[:60] + [(1000 + r[0], f" {r[1]}".replace(" ", "\t ")[1:]) for r in corpus[:20]] + ODD
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert as_tuples(exact_dedup.exact_groups(make_docs(rows)).select(columns)) == brute_exact(rows)


def test_exact_tells_confused_digests_apart(spark, make_docs):
    rows = [(k, f"text {k % 3} of five") for k in range(9)] + [(20, None), (21, "")]
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    confused = exact_dedup.exact_groups(make_docs(rows), digest_of=lambda body: F.substring(body, 1, 4))
    assert as_tuples(confused.select(columns)) == brute_exact(rows)


def test_exact_state_remembers_earlier_runs(spark, tmp_path):
    first = [("a", 5, "x"), ("b", 6, "x")]
    for k, rows in enumerate([first, [("a", 3, "y"), ("c", 9, "y")]]):
        spark.createDataFrame(rows, exact_dedup.ARRIVALS).write.mode("append").parquet(f"{tmp_path}/in")
        exact_dedup.absorb(spark, f"{tmp_path}/in", f"{tmp_path}/state")
    held = exact_dedup.holders(spark, f"{tmp_path}/state")
    assert as_tuples(held) == [("a", 3, "y", 2), ("b", 6, "x", 1), ("c", 9, "y", 1)]


def test_exact_opens_stores_by_rows(spark, make_docs, tmp_path):
    wide = {"spark.sql.shuffle.partitions": "40"}
    arrivals = [(f"d{k % 50}", k, "x") for k in range(100)]
    spark.createDataFrame(arrivals, exact_dedup.ARRIVALS).repartition(100).write.parquet(f"{tmp_path}/in")
    with exact_dedup._conf(spark, wide):
        exact_dedup.absorb(spark, f"{tmp_path}/in", f"{tmp_path}/state")
    held = exact_dedup.holders(spark, f"{tmp_path}/state")
    assert as_tuples(held) == sorted((f"d{k}", k, "x", 2) for k in range(50))
    # One batch, however many files; parts by rows and cores, not by the session's partitions.
    assert len([p for p in (tmp_path / "state/commits").iterdir() if p.name.isdigit()]) == 1
    parts = [p for p in (tmp_path / "state/state/0").iterdir() if p.name.isdigit()]
    assert len(parts) == spark.sparkContext.defaultParallelism < 40


def test_exact_reads_its_state_once(spark, make_docs):
    answer = exact_dedup.exact_groups(make_docs(ODD))
    assert "BatchScan" not in answer._jdf.queryExecution().optimizedPlan().toString() + \
        answer._jdf.queryExecution().executedPlan().toString()


def test_exact_leaves_one_of_each(spark, make_docs):
    docs = make_docs(ODD + [(30, "only me"), (30, "and me")])
    left = exact_dedup.deduplicated(docs)
    assert left.columns == docs.columns
    bodies = [SPACES.sub(" ", r["text"] or "") for r in left.collect()]
    assert sorted(bodies) == sorted({SPACES.sub(" ", t or "") for _, t, *_ in ODD} | {"only me", "and me"})
    assert exact_dedup.exact_groups(make_docs([])).count() == 0


def brute_print(text):
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode().lower()) if w]
    size = min(3, len(words))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + size]), 42) for k in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    parent = {k: k for k in range(len(prints))}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in combinations(range(len(prints)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            parent[root(a)] = root(b)
    return [root(k) for k in range(len(prints))]


def test_simhash_groups(spark, make_docs, corpus):
    rows = corpus[:80] + [(500 + k, text + " tail", "en", "s") for k, text, *_ in corpus[:40]] + ODD[1:]
    prints = [brute_print(r[1]) for r in rows]
    roots = brute_components(prints)
    least = {}
    for (doc_id, *_), r in zip(rows, roots):
        least[r] = min(least.get(r, doc_id), doc_id)
    want = sorted((r[0], f"{p:016x}", least[c]) for r, p, c in zip(rows, prints, roots))
    want.sort(key=repr)
    assert as_tuples(simhash.near_duplicates(make_docs(rows))) == want
    assert simhash.near_duplicates(make_docs([])).count() == 0
    assert simhash.near_duplicates(make_docs([(None, None), (None, "")])).count() == 2


def test_a_near_duplicate_takes_no_other_text_with_it(spark, make_docs):
    shared, alone, other = "one two three four five six", "quite another text than that", "words of no other row"
    rows = [(3, shared), (None, shared.upper()), (None, alone), (4, other), (4, shared), (None, "no id here"),
            (None, "NO id here"), (5, "same id twice"), (5, "SAME id twice"), (6, "a copy"), (6, "a copy")]
    left = [(r["doc_id"], r["text"].lower()) for r in simhash.deduplicated(make_docs(rows)).collect()]
    assert sorted(left, key=repr) == sorted([
        (3, shared), (None, alone), (4, other), (None, "no id here"), (5, "same id twice"), (6, "a copy")], key=repr)
    assert simhash.deduplicated(make_docs([])).count() == 0


def test_spark_hash_is_the_contracts(spark):
    text = "some three words"
    row = spark.createDataFrame([(text,)], "t string").select(F.xxhash64("t")).first()
    assert row[0] % (1 << 64) == xxhash.xxh64_intdigest(text, 42)


@pytest.mark.parametrize("paired_list", [64, 1])
def test_links_connect_all_within_two_bits(spark, paired_list):
    draw = np.random.default_rng(4)
    base = [int(v) for v in draw.integers(0, 1 << 63, 6)]
    prints = set()
    for b in base:
        chain = b
        for _ in range(25):
            for bit in draw.integers(0, 64, int(draw.integers(1, 4))):
                chain ^= 1 << int(bit)
            prints.add(chain % (1 << 64))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.print_links(
        spark.createDataFrame([(p,) for p in signed], "print long"), paired_list=paired_list)
    edges = links.collect()
    assert all(((e["a"] ^ e["b"]) % (1 << 64)).bit_count() <= 2 for e in edges)
    members = {r["node"]: r["component"] for r in components.connected_components(links).collect()}
    roots = brute_components(prints)
    for a, b in combinations(range(len(prints)), 2):
        found = members.get(signed[a], signed[a]) == members.get(signed[b], signed[b])
        assert found == (roots[a] == roots[b])


def test_components_of_a_long_chain(spark):
    edges = [(k, k + 1) for k in range(0, 300)] + [(1000, 1001), (1001, 1002), (5, 5)]
    found = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
    want = [(k, 0) for k in range(301)] + [(k, 1000) for k in (1000, 1001, 1002)]
    assert as_tuples(found) == sorted(want, key=repr)


def brute_suffix(rows):
    """Every 100-byte window against all that start earlier."""
    texts = {}
    for doc_id, text, *_ in rows:
        texts[doc_id] = (text or "").encode()
    seen, out = set(), []
    for doc_id in sorted(texts, key=lambda i: (i is not None, i or 0)):
        data = texts[doc_id]
        cover = np.zeros(len(data), dtype=bool)
        for at in range(len(data) - 99):
            window = data[at : at + 100]
            if window in seen:
                cover[at : at + 100] = True
            seen.add(window)
        kept = bytes(b for b, c in zip(data, cover) if not c)
        runs = int((cover & ~np.concatenate(([False], cover[:-1]))).sum()) if len(data) else 0
        out.append((doc_id, len(data), int(cover.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


PASSAGE = "a passage of more than a hundred bytes that stands in many documents, word for word, and é too: "


@pytest.mark.parametrize("hot_covers", [20_000, 3])
def test_suffix_dedup(spark, make_docs, corpus, hot_covers):
    rows = corpus[:60]
    rows += [(300 + k, f"start {k} {PASSAGE} {PASSAGE[:-k - 1]} end {k}", "en", "s") for k in range(12)]
    rows += [(400, "z" * 1000, "en", "s"), (401, "ab" * 400 + "c" + "ab" * 400, "en", "s"), (None, PASSAGE, "en", "s"),
             (402, None, "en", "s"), (403, "", "en", "s"), (404, "z" * 99, "en", "s")]
    found = suffix_dedup.without_repeats(make_docs(rows), hot_covers=hot_covers)
    assert as_tuples(found) == brute_suffix(rows)


def test_suffix_dedup_rows_that_repeat_an_id(spark, make_docs):
    text = " ".join(f"word{k}" for k in range(60))
    found = suffix_dedup.without_repeats(make_docs([(1, text), (1, text), (2, text), (2, "short")]))
    assert sorted(r["n_removed"] for r in found.collect()) == [0, 0, 5, len(text)]
    assert suffix_dedup.without_repeats(make_docs([])).count() == 0


def test_suffix_dedup_deals_large_texts_to_more_tasks(spark, make_docs, corpus, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 2000, raising=False)
    rows = corpus[:30] + [(500 + k, f"{t} {k}", "en", "s") for k, (_, t, *_) in enumerate(corpus[:30])]
    dealt, spans = suffix_dedup.repeated_spans(make_docs(rows))
    need = sum(len((t or "").encode()) for _, t, *_ in rows) / 2000
    assert need > 20 and dealt.rdd.getNumPartitions() >= need and spans.rdd.getNumPartitions() >= need
    assert as_tuples(suffix_dedup.without_repeats(make_docs(rows))) == brute_suffix(rows)


def test_entries_are_dealt_evenly(corpus):
    batch = pa.RecordBatch.from_pydict({"doc": list(range(100)), "text": [r[1] for r in corpus[:100]]})
    dealt = {}
    for out in suffix_dedup._ship(8)(iter([batch])):
        for bucket, payload in zip(out.column("bucket").to_pylist(), out.column("payload").to_pylist()):
            if payload is not None:
                dealt[bucket] = dealt.get(bucket, 0) + len(suffix_dedup._unpacked(payload)["key"])
    assert len(dealt) == 8 and max(dealt.values()) < 2 * min(dealt.values())


def test_covers_are_handed_on_in_bounded_blocks(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "COVER_BYTES", 20_000, raising=False)
    draw = np.random.default_rng(3)
    texts = [bytes(draw.integers(97, 123, 1000, dtype=np.uint8)).decode() for _ in range(20)]
    asked = [[{"first": at, "key": at, "count": 50, "offset": 60, "hot": int(hot)}
              for at in range(0, 800, 50) for hot in (0, 1)] for _ in texts]
    kind = pa.list_(pa.struct([("first", pa.int64()), ("key", pa.int64()), ("count", pa.int32()),
                               ("offset", pa.int32()), ("hot", pa.int32())]))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(20), pa.int64()), pa.array(texts), pa.array(asked, kind)], names=["doc", "text", "asked"])
    out = list(suffix_dedup._covers(iter([batch.slice(0, 11), batch.slice(11)])))
    assert max(sum(map(len, b.column("cover").to_pylist())) for b in out) < 30_000
    found = sorted((r["doc"], r["first"], r["count"], r["cover"]) for b in out for r in b.to_pylist())
    assert found == sorted(
        (doc, at + k, n, text[at + k : at + k + n + 99].encode())
        for doc, text in enumerate(texts) for at in range(0, 800, 50)
        for k, n in [(0, 50), *((k, 1) for k in range(50))])


def test_windows_are_sorted_in_bounded_blocks(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SORT_BYTES", 2000, raising=False)
    blocks, whole = [], suffix_dedup._repeats

    def watched(*columns):
        blocks.append(sum(map(len, columns[-1])))
        return whole(*columns)

    monkeypatch.setattr(suffix_dedup, "_repeats", watched)
    keys = np.repeat(np.arange(50), 2)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(keys), pa.array(np.arange(100)), pa.array(np.zeros(100, np.int64)),
         pa.array(np.ones(100, np.int32)), pa.array(np.full(100, -1, np.int32)),
         pa.array([bytes([k]) * 100 for k in keys.tolist()], pa.binary())],
        names=["key", "doc", "first", "count", "offset", "cover"])
    out = list(suffix_dedup._sort_suffixes(batch.slice(at, 7) for at in range(0, 100, 7)))
    assert len(blocks) > 3 and max(blocks) <= 2000 + 2 * 700 and sum(blocks) == 10_000
    assert sorted(d for b in out for d in b.column("doc").to_pylist()) == list(range(1, 100, 2))


def test_met_rows_are_stored_packed():
    n = 600_000
    spans = {"doc": np.repeat(np.arange(n // 60), 60), "start": np.tile(np.arange(60) * 130, n // 60)}
    spans["stop"] = spans["start"] + 170
    stored = suffix_dedup._met_spans(**spans)
    assert stored.num_rows == 3 and stored.nbytes < 8 * n
    back = pa.Table.from_batches(suffix_dedup._rows_of(suffix_dedup._SPAN_FIELDS)(iter([stored])))
    assert all((back.column(c).to_numpy() == v).all() for c, v in spans.items())
    entries = {"doc": np.array([-(1 << 63), 7]), "first": np.array([1 << 35, 0]), "count": np.array([69, 1], np.uint8),
               "key": np.array([(1 << 64) - 2, 4], np.uint64), "offset": np.array([68, 0], np.uint8)}
    asked = suffix_dedup._met_requests(entries, np.array([True, True]), hot=True)
    rows = pa.Table.from_batches(suffix_dedup._rows_of(suffix_dedup._ASKED_FIELDS)(iter([asked]))).to_pylist()
    assert rows[0] == {"doc": -(1 << 63), "first": 1 << 35, "key": -2, "count": 69, "offset": 68, "hot": 1}
    assert rows[1]["doc"] == 7 and not suffix_dedup._met_requests(entries, np.array([False, False]), hot=False).num_rows


@pytest.mark.parametrize("distinct", [1, 8, 16, 24])
def test_blocks_without_a_repeat(distinct):
    """Windows that share an anchor and are all told apart after some of the rounds, or at once."""
    covers = [bytes(range(100, 100 + distinct - 1)) + bytes([k]) + bytes(100 - distinct) for k in range(3)]
    one, doc = np.ones(3, np.int64), np.arange(3)
    for key in (one, doc):
        assert [len(c) for c in suffix_dedup._repeats(key, doc, doc, one, one, covers)] == [0, 0, 0]
    found = suffix_dedup._repeats(one[[0, 0, 0, 0]], np.arange(4), np.zeros(4, np.int64), one[[0, 0, 0, 0]],
                                  one[[0, 0, 0, 0]], [*covers, covers[1]])
    assert [c.tolist() for c in found] == [[3], [0], [100]]


def test_partition_with_hot_keys_alone(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SETTLE_ENTRIES", 10)
    entries = {"key": np.full(20, 4, np.uint64), "cover": np.arange(20, dtype=np.uint64), "doc": np.arange(20),
               "first": np.zeros(20, np.int64), "count": np.ones(20, np.int64), "offset": np.zeros(20, np.int64)}
    batch = pa.RecordBatch.from_pydict({"payload": [suffix_dedup._packed(entries, np.arange(20))]})
    out = list(suffix_dedup._meet(3)(iter([batch])))
    asked = pa.Table.from_batches(suffix_dedup._rows_of(suffix_dedup._ASKED_FIELDS)(
        b for b in out if b.num_rows and b.column("doubt")[0].as_py()))
    assert sorted(asked.column("doc").to_pylist()) == list(range(20)) and set(asked.column("hot").to_pylist()) == {1}


def test_long_texts_in_pieces(monkeypatch):
    draw = np.random.default_rng(1)
    text = bytes(draw.integers(97, 101, 3000, dtype=np.uint8))
    whole = suffix_dedup._joined(list(suffix_dedup._blocks([1], [text])))
    monkeypatch.setattr(suffix_dedup, "LONG_TEXT", 700)
    cut = suffix_dedup._joined(list(suffix_dedup._blocks([1], [text])))
    windows = lambda e: sorted(
        (int(f) + k, int(f + o)) for f, n, o in zip(e["first"], e["count"], e["offset"]) for k in range(n))
    assert windows(whole) == windows(cut) and len(windows(cut)) == 2901


def test_deep_groups_are_told_apart_in_the_last_byte():
    common = bytes(range(99))
    data = b"".join(common + bytes([x]) for x in (1, 2, 1, 3, 2)) + bytes(8)
    raw = np.frombuffer(data, np.uint8)
    symbols = np.zeros(len(raw) - 7, dtype=np.uint64)
    for k in range(8):
        symbols = (symbols << np.uint64(8)) | raw[k : len(raw) - 7 + k]
    rows, classes = suffix_dedup.equal_windows(symbols, np.arange(5) * 100, np.zeros(5, dtype=np.int64))
    groups = {}
    for r, c in zip(rows, classes):
        groups.setdefault(int(c), set()).add(int(r))
    assert sorted(map(sorted, groups.values())) == [[0, 2], [1, 4]]


@pytest.mark.parametrize("piece", [1, 3, 50])
def test_fingerprints_do_not_depend_on_pieces(monkeypatch, piece):
    monkeypatch.setattr(simhash, "PIECE", piece)
    for text in ("", "  \n", "A", "a b", "One two\x0bthree  four é five\nsix seven " * 9, " x" * 40):
        assert simhash.fingerprint(text.encode()) % 2**64 == brute_print(text) % 2**64
