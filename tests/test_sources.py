import pytest

from tallystar import vocab
from tallystar.schemas import DIMENSIONS, EXPORTED, FACTS, RELATIONSHIPS
from tallystar.sources import releases, tables
from tests.conftest import tuples

CSV = (
    '﻿"REF_DATE","GEO","Type of dwelling unit","VALUE"\n'
    '"2020-01","Trois-Rivières, Quebec","Total ""units""","12"\n'
    '"2020-02","St. John\'s, Newfoundland and Labrador","Row units","F"\n'
    '"2020-03","Canada","Row units",""\n'
)


@pytest.fixture()
def raw_dir(tmp_path):
    folder = tmp_path / "absorptions"
    folder.mkdir()
    (folder / f"{releases.REGISTRY['absorptions'].pid}.csv").write_text(CSV, encoding="utf-8")
    return str(tmp_path)


def test_registry_names_every_release():
    assert set(releases.REGISTRY) == {name for _, name, _ in vocab.RELEASES}
    assert all(release.description for release in releases.REGISTRY.values())
    assert releases.REGISTRY["price_index"].path("/raw/") == "/raw/price_index/18100205.csv"


def test_csv_is_read_as_text(spark, raw_dir):
    frame = releases.read_release(spark, raw_dir, "absorptions")
    assert {f.dataType.simpleString() for f in frame.schema.fields} == {"string"}
    assert frame.columns[0] == "REF_DATE"
    rows = [tuple(r) for r in frame.orderBy("REF_DATE").collect()]
    assert rows[0] == ("2020-01", "Trois-Rivières, Quebec", 'Total "units"', "12")
    assert rows[1][1] == "St. John's, Newfoundland and Labrador" and rows[1][3] == "F"
    assert rows[2][3] in (None, "")


def test_header_sniffing(spark, raw_dir):
    frame = releases.read_release(spark, raw_dir, "absorptions")
    assert releases.column_starting_with(frame, "Type of") == "Type of dwelling unit"
    assert releases.column_starting_with(frame, "New housing") is None
    rate = spark.createDataFrame([("2020-01", "1")], "REF_DATE string, VALUE string")
    found = releases.with_column({"a": frame, "r": rate}, "GEO")
    assert [c for _, c in found] == ["GEO"]
    assert [c for _, c in releases.with_prefix({"a": frame, "r": rate}, "Type of")] == [
        "Type of dwelling unit"
    ]


def test_schemas_are_complete():
    assert len(DIMENSIONS) == 8 and len(FACTS) == 7
    assert len(EXPORTED) == 19
    assert len(RELATIONSHIPS) == 19
    assert ("dim_geography", "fact_mortgage_arrears") not in RELATIONSHIPS


def test_clustered_table_round_trip(spark, tmp_path):
    rows = [(y * 10000 + m * 100 + 1, g, None) for y in (1999, 2000) for m in (1, 2) for g in (1, 2)]
    schema = FACTS["fact_price_index"]
    frame = spark.createDataFrame(
        [(k, g, 1, v) for k, g, v in rows],
        "date_key int, geography_key int, price_component_key int, index_value decimal(12,4)",
    )
    path = str(tmp_path / "t")
    assert tables.write_table(frame, path, ("date_key", "geography_key")) == 8
    assert (tmp_path / "t" / "year=1999").is_dir()
    back = tables.read_table(spark, path, schema)
    assert back.columns == schema.fieldNames()
    assert tuples(back) == tuples(frame)
    late = tables.read_table(spark, path, schema, first_month=20000101, last_month=20000101)
    assert tuples(late, "date_key", "geography_key") == [(20000101, 1), (20000101, 2)]


def test_month_bounds_prune_year_folders(spark, tmp_path, capsys):
    frame = spark.createDataFrame([(19990101, None), (20000101, None)],
                                  "date_key int, rate_5year decimal(9,4)")
    path = str(tmp_path / "t")
    tables.write_table(frame, path, ("date_key",))
    tables.read_table(spark, path, FACTS["fact_mortgage_rate"], 20000101).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "GreaterThanOrEqual(date_key,20000101)" in plan


def test_refused_publication_leaves_the_last_one(spark, tmp_path):
    root = str(tmp_path / "out")
    assert tables.current_version(spark, root) is None
    frame = spark.range(5)
    assert tables.publish({"t": frame}, root, "v1", ["broken"]) is None
    assert tables.current_version(spark, root) is None
    manifest = tables.publish({"t": frame, "u": frame.limit(0)}, root, "v1", [])
    counts = tuples(manifest, "table_name", "n_rows")
    assert counts == [("t", 5), ("u", 0)]
    assert all(r["n_bytes"] > 0 for r in manifest.collect())
    totals = tables.manifest_totals(manifest).first()
    assert (totals["n_tables"], totals["n_rows"]) == (2, 5)
    assert tables.publish({"t": frame}, root, "v2", ["broken"]) is None
    assert tables.current_version(spark, root) == "v1"
    tables.publish({"t": frame}, root, "v2", [])
    assert tables.current_version(spark, root) == "v2"
    with pytest.raises(ValueError, match="published already"):
        tables.publish({"t": frame}, root, "v1", [])


def test_pages_of_split_files_keep_their_numbers(spark, tmp_path):
    """One file of two in five pages, read in hundreds of splits beside small ones."""
    sizes = {"large.txt": 400, **{f"small{k}.txt": 60 for k in range(10)}}
    for name, n in sizes.items():
        (tmp_path / name).write_text("\f".join(f"{name} page {k}\n" + "x" * (k % 40) for k in range(n)))
    conf = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    before = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        frame = releases.read_report_pages(spark, str(tmp_path))
        assert frame.rdd.getNumPartitions() > 30
        found = frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(found) == sum(sizes.values())
    for row in found:
        name = row["doc_id"].rsplit("/", 1)[1]
        assert row["text"].startswith(f"{name} page {row['page_no']}\n")
    # Text is read once without an exchange; the window goes over splits alone.
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanged and all("value" not in line and "text" not in line for line in exchanged)


def test_values_with_line_breaks_are_refused(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text('a,b\n"x ""quoted""",1\n')
    bad.write_text('a,b\n"two\nlines",1\n')
    releases.require_whole_lines(spark, [str(good)])
    with pytest.raises(ValueError, match="bad.csv"):
        releases.require_whole_lines(spark, [str(good), str(bad)])
