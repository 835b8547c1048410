"""Storage in boxes: ranks, bit order, files left out by any key; digests of exports."""

import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tallystar.schemas import FACTS
from tallystar.sources import layout, tables

KEYS = ("date_key", "price_component_key", "geography_key")
SCHEMA = "date_key int, geography_key int, price_component_key int, index_value decimal(12,4)"


@pytest.fixture(scope="module")
def rows():
    """Two years; place 7 holds a third of the rows."""
    rng = random.Random(5)
    return [
        (y * 10000 + m * 100 + 1, 7 if rng.random() < 0.33 else rng.randrange(1, 400), c, None)
        for y in (2001, 2002) for m in range(1, 13) for c in (1, 2) for _ in range(250)
    ]


def files_touched(folder, key, value):
    """Files whose least and greatest value of ``key`` do not rule ``value`` out."""
    touched = total = 0
    for path in Path(folder).rglob("*.parquet"):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.to_arrow_schema().get_field_index(key)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        touched += any(s.min <= value <= s.max for s in stats)
        total += 1
    return touched, total


def test_ranks_count_the_bounds_below(spark):
    bounds = [3, 5, 9, 9_000_000_000]
    values = [None, -4, 3, 4, 5, 6, 9, 10, 9_000_000_000, 9_000_000_001]
    frame = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = [r[0] for r in frame.select(layout.rank_among(F.col("v"), bounds)).collect()]
    assert got == [0 if v is None else sum(b < v for b in bounds) for v in values]
    assert {r[0] for r in frame.select(layout.rank_among(F.col("v"), [])).collect()} == {0}


def test_bits_are_taken_in_turn(spark):
    pairs = [(a, b) for a in range(8) for b in range(4)]
    frame = spark.createDataFrame(pairs, "a int, b int")
    got = {(r["a"], r["b"]): r["z"] for r in frame.select(
        "*", layout.interleaved([("a", 3), ("b", 2)]).alias("z")).collect()}
    for (a, b), z in got.items():
        bits = f"{a:03b}", f"{b:02b}"
        assert z == int(bits[0][0] + bits[1][0] + bits[0][1] + bits[1][1] + bits[0][2], 2)
    assert sorted(got.values()) == list(range(32))
    with pytest.raises(ValueError, match="do not fit"):
        layout.rank_bounds(frame, ["a", "b"], bits=40)


def test_bounds_follow_the_rows(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    n, bounds = layout.rank_bounds(frame, ["geography_key", "price_component_key", "index_value"], 4)
    assert n == len(rows)
    assert bounds["index_value"] == [] and bounds["price_component_key"][0] == 1
    assert 7 in bounds["geography_key"] and len(bounds["geography_key"]) < 15
    assert layout.rank_bounds(frame.limit(0), ["geography_key"]) == (0, {"geography_key": []})


def test_boxes_leave_out_files_by_any_key(spark, rows, tmp_path):
    frame = spark.createDataFrame(rows, SCHEMA)
    flat, boxed = str(tmp_path / "flat"), str(tmp_path / "boxed")
    size = 250
    assert tables.write_table(frame, boxed, KEYS, boxes=True, rows_per_file=size) == len(rows)
    # The same files by month first, as many rows in each.
    (frame.withColumn("year", F.expr("date_key div 10000")).repartition("year")
     .sortWithinPartitions("year", *KEYS).write.option("maxRecordsPerFile", size)
     .partitionBy("year").parquet(flat))
    schema = FACTS["fact_price_index"]
    back = tables.read_table(spark, boxed, schema)
    assert tuples(back) == tuples(frame)
    assert tuples(tables.read_table(spark, boxed, schema, 20020301, 20020401)) == tuples(
        frame.filter("date_key BETWEEN 20020301 AND 20020401"))
    n_files = files_touched(boxed, "date_key", 0)[1]
    assert n_files >= len(rows) // size
    touched = {boxed: [], flat: []}
    for place in range(50, 400, 50):
        for folder, parts in touched.items():
            some, every = files_touched(folder, "geography_key", place)
            parts.append(some / every)
        assert tuples(back.filter(F.col("geography_key") == place)) == tuples(
            frame.filter(F.col("geography_key") == place))
    assert min(touched[flat]) > 0.9  # by month, any file may hold any place
    assert sum(touched[boxed]) < 0.7 * sum(touched[flat])
    # Months still leave files out, beyond the folder of their year.
    assert files_touched(boxed, "date_key", 20020601)[0] < 0.3 * n_files


def test_boxes_of_odd_tables(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert tables.write_table(empty, str(tmp_path / "empty"), KEYS, boxes=True) == 0
    odd = [(20010101, None, 1, None), (20010101, None, 1, None), (20020101, -1, None, None)]
    frame = spark.createDataFrame(odd, SCHEMA)
    assert tables.write_table(frame, str(tmp_path / "odd"), KEYS, boxes=True, rows_per_file=1) == 3
    assert tuples(tables.read_table(spark, str(tmp_path / "odd"), FACTS["fact_price_index"])) == tuples(frame)


def test_digest_tells_what_counts_cannot(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a"), (2, None), (None, "b"), (2, None)], "k int, v string")
    manifest = tables.export_tables({"t": frame, "u": frame.limit(0)}, str(tmp_path / "x")).cache()
    read = {name: spark.read.parquet(str(tmp_path / "x" / name)) for name in ("t", "u")}
    assert tuples(tables.altered_tables(manifest, read)) == []
    shuffled = {**read, "t": read["t"].repartition(3)}
    assert tuples(tables.altered_tables(manifest, shuffled)) == []
    swapped = spark.createDataFrame([(2, "a"), (1, None), (None, "b"), (2, None)], "k int, v string")
    assert tuples(tables.altered_tables(manifest, {**read, "t": swapped}), "table_name") == [("t",)]
    moved = spark.createDataFrame([(1, "a"), (2, None), (2, None), (2, "b")], "k int, v string")
    assert tuples(tables.altered_tables(manifest, {**read, "t": moved}), "table_name") == [("t",)]
    assert tuples(tables.altered_tables(manifest, {"t": read["t"]}), "table_name") == [("u",)]
