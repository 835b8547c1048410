from tallystar.operators.report_text import arrears_release, extract_records, page_sections
from tallystar.sources.releases import read_report_pages
from tests.conftest import tuples

PAGES = [
    ("d", 0, "Summary of all regions\n1995-01 9,999,999 1 0.10%"),
    ("d", 1, "Mortgages in arrears\nREGION: ONTARIO**\nAs at: Total Arrears %\n"
             "1995-01  2,184,443  11,014  0.50%   2011-01  4,192,307  18,702  0.45%"),
    ("d", 2, "1995-02  2,185,000  11,000  0.50%\n1995-01  2,184,443  11,014  0.50%"),
    ("d", 3, "REGION: BRITISH COLUMBIA\n1995-01  100,000  500  0.50%"),
    ("d", 4, "REGION: TERRITORIES*\n2001-01 1,200   2011-01 2,300\n2001-02 1,250 0.40%"),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "doc_id string, page_no int, text string")


def test_records(spark):
    found = tuples(
        extract_records(pages(spark)), "region", "month", "total_mortgages",
        "mortgages_in_arrears", "arrears_rate", "suppressed",
    )
    assert found == [
        ("BRITISH COLUMBIA", "1995-01", 100000, 500, 0.5, False),
        ("ONTARIO", "1995-01", 2184443, 11014, 0.5, False),
        ("ONTARIO", "1995-02", 2185000, 11000, 0.5, False),
        ("ONTARIO", "2011-01", 4192307, 18702, 0.45, False),
        # Hidden counts: the second record of the line survives, a lone percent stays one.
        ("TERRITORIES", "2001-01", 1200, None, None, True),
        ("TERRITORIES", "2001-02", 1250, None, 0.4, True),
        ("TERRITORIES", "2011-01", 2300, None, None, True),
    ]


def test_a_misprint_is_not_suppression(spark):
    row = extract_records(
        pages(spark, [("d", 1, "REGION: QUEBEC\n1999-01 99,999,999,999,999,999,999,999 5 0.10%")])
    ).first()
    assert row["parse_failed"] and not row["suppressed"]
    assert row["total_mortgages"] is None and row["mortgages_in_arrears"] == 5


def test_sections_do_not_leak_between_documents(spark):
    rows = [("a", 1, "REGION: QUEBEC"), ("b", 1, "no header"), ("b", 2, "REGION: ALBERTA"),
            ("b", 3, "more")]
    assert tuples(page_sections(pages(spark, rows))) == [
        ("a", 1, "QUEBEC"), ("b", 2, "ALBERTA"), ("b", 3, "ALBERTA")
    ]


def test_pages_of_a_text_file(spark, tmp_path):
    (tmp_path / "report.txt").write_text("\f".join(text for _, _, text in PAGES))
    read = read_report_pages(spark, str(tmp_path))
    assert [r["page_no"] for r in read.orderBy("page_no").collect()] == [0, 1, 2, 3, 4]
    assert extract_records(read).count() == 7


def test_one_record_per_month_over_several_documents(spark):
    rows = [("b", 1, "REGION: QUEBEC\n1999-01 200 2 1.00%"),
            ("a", 7, "REGION: QUEBEC\n1999-01 100 1 1.00%\n1999-02 101")]
    found = extract_records(pages(spark, rows), ("region", "month"))
    assert tuples(found, "doc_id", "month", "total_mortgages") == [
        ("a", "1999-01", 100), ("a", "1999-02", 101)
    ]


def test_release_tells_hidden_from_unreadable(spark):
    huge = "9" * 30
    rows = [("d", 1, f"REGION: QUEBEC\n1999-01 100\n1999-02 100 {huge} 0.10%\n1999-03 1,000 7 0.70%")]
    release = arrears_release(extract_records(pages(spark, rows)))
    assert tuples(release, "month", "total_mortgages", "mortgages_in_arrears") == [
        ("1999-01", "100", None), ("1999-02", "100", "unreadable"), ("1999-03", "1000", "7")
    ]
