from pyspark.sql import functions as F

from tallystar.operators import quality
from tests.conftest import tuples


def test_duplicate_keys(spark):
    clean = spark.createDataFrame([(1, "a"), (1, "b")], "k int, s string")
    assert quality.duplicate_keys(clean, ["k", "s"]).count() == 0
    broken = clean.union(clean.filter("s = 'b'"))
    assert tuples(quality.duplicate_keys(broken, ["k", "s"])) == [(1, "b", 2)]


def test_orphans_are_found_and_counted(spark):
    dim = spark.createDataFrame([(1,), (2,)], "id int")
    fact = spark.createDataFrame([(1,), (3,), (3,), (None,)], "k int")
    assert tuples(quality.orphans(fact, dim, "k", "id")) == [(3,), (3,), (None,)]
    assert quality.orphan_count(fact, dim, "k", "id").first()[0] == 3
    assert quality.orphan_count(fact.filter("k = 1"), dim, "k", "id").first()[0] == 0
    edges = [("d", "id", "f", "k")]
    assert tuples(quality.referential_integrity({"d": dim, "f": fact}, edges)) == [
        ("d", "f", "k", 3)
    ]


def test_unknown_rows_per_key(spark):
    fact = spark.createDataFrame([(1, -1), (2, 5), (-1, -1)], "a int, b int")
    assert tuples(quality.unknown_rows(fact, ["a", "b"]), "key", "unknown_rows") == [
        ("a", 1), ("b", 2)
    ]


def test_member_count(spark):
    dim = spark.createDataFrame([("x", "P"), ("y", "P"), (None, "P"), ("z", "Q")],
                                "code string, level string")
    wanted = F.col("level") == "P"
    assert tuple(quality.member_count(dim, "code", wanted, 2).first()) == (2, True)
    assert tuple(quality.member_count(dim, "code", wanted, 3).first()) == (2, False)


def test_suppression(spark):
    rows = [(True, None), (False, 3), (True, 4)]
    fact = spark.createDataFrame(rows, "is_hidden boolean, n int")
    assert tuples(quality.broken_suppression(fact, "is_hidden", "n")) == [(True, 4)]
    assert quality.broken_suppression(fact.filter("n is null"), "is_hidden", "n").count() == 0


def test_flow_vs_snapshot_looks_at_the_latest_month(spark):
    def plausible(*rows):
        fact = spark.createDataFrame(list(rows), "date_key int, flow int, snap int")
        return quality.flow_vs_snapshot(fact, "flow", "snap").first()["plausible"]

    assert plausible((1, 100, 1), (2, 5, 30), (2, 5, 90))
    assert not plausible((1, 1, 1000), (2, 90, 5))
    assert not plausible((2, None, 90))


def test_history_span(spark):
    fact = spark.createDataFrame([(1990, 1), (2000, 1), (2005, None)], "y int, v int")
    assert tuple(quality.history_span(fact, "v", F.col("y")).first()) == (1990, 2000, 10, True)
    assert not quality.history_span(fact.filter("y > 1995"), "v", F.col("y")).first()["long_enough"]


def test_non_empty(spark):
    frames = {"full": spark.range(3), "empty": spark.range(0)}
    assert tuples(quality.is_non_empty(frames)) == [("empty", False), ("full", True)]


def test_integrity_by_bitmaps_and_by_counts(spark):
    """Keys around the ends of buckets and words, negative, missing and far away."""
    keys = [1, 2, 63, 64, 65, 127, 128, 32767, 32768, 32769, 65536, 70000, -1, 0, 2**40]
    strays = [3, 66, 129, 32766, 65537, -2, 2**40 + 1, 10**12]
    d = spark.createDataFrame([(k,) for k in keys], "k bigint")
    e = spark.createDataFrame([(k,) for k in range(1, 300)], "k int")
    rows = [(k, j % 310) for j, k in enumerate([*keys, *strays, None] * 20)]
    f = spark.createDataFrame(rows, "d bigint, e int")
    edges = [("d", "k", "f", "d"), ("e", "k", "f", "e"), ("e", "k", "g", "e")]
    tables = {"d": d, "e": e, "f": f, "g": f.limit(0)}
    known_d, known_e = set(keys), set(range(1, 300))
    want = sorted([
        ("d", "f", "d", sum(k not in known_d for k, _ in rows)),
        ("e", "f", "e", sum(k not in known_e for _, k in rows)), ("e", "g", "e", 0)])
    assert tuples(quality.referential_integrity(tables, edges)) == want
    assert tuples(quality.referential_integrity(tables, edges, key_buckets=1)) == want


def test_integrity_scans_a_fact_once_and_shuffles_counts(spark, tmp_path):
    spark.range(1000).selectExpr("CAST(id AS INT) k").write.parquet(f"{tmp_path}/dim")
    spark.range(5000).selectExpr("CAST(id % 900 AS INT) a", "CAST(id AS INT) b").write.parquet(f"{tmp_path}/fact")
    tables = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in ("dim", "fact")}
    edges = [("dim", "k", "fact", "a"), ("dim", "k", "fact", "b")]
    found = quality.referential_integrity(tables, edges)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "Exchange hashpartitioning" not in plan and plan.count("Exchange SinglePartition") == 1
    assert tuples(found) == [("dim", "fact", "a", 0), ("dim", "fact", "b", 4000)]
