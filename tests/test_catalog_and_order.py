"""Catalogue tables over date prefixes, and reports numbered in reading order."""

import datetime
from pathlib import Path

import pytest

from remitmatch.schemas import FLAT
from remitmatch.sinks import outputs
from remitmatch.sources import catalog
from remitmatch.sources.documents import read_csv_text
from remitmatch.sources.flat_csv import load_flat_tables

HEADER = "payment_id,invoice_id,customer_id,payment_date,amount_paid,payment_method,reference_number,status,notes"


@pytest.fixture
def database(spark):
    name = "catalog_test"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def day(n):
    return datetime.date(2024, 1, n)


def put(root, folder, *ids, name="payments.csv"):
    path = Path(root) / "payments" / folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([HEADER, *[f'{i},INV-1,CUST-1,2024-01-01,1.00,ACH,,CLEARED,"two\nlines, one cell"' for i in ids]]) + "\n")
    return path


def ids(spark, database, where="true"):
    return sorted((r.run_date, r.payment_id) for r in spark.table(f"{database}.payments").where(where).collect())


def test_new_and_vanished_dates(spark, tmp_path, database):
    put(tmp_path, "2024-01-01", "a", "b")
    put(tmp_path, "run_date=2024-01-02", "c")
    put(tmp_path, "2024-01-03/payments.csv", "d", name="part-0.csv")
    put(tmp_path, "archive", "x")
    put(tmp_path, "2024-13-01", "y")
    (tmp_path / "payments" / "2024-01-04").mkdir()
    changes = catalog.crawl(spark, str(tmp_path), database)
    assert changes == {"invoices": ([], []), "payments": ([day(1), day(2), day(3)], []), "returns": ([], [])}
    assert ids(spark, database) == [(day(1), "a"), (day(1), "b"), (day(2), "c"), (day(3), "d")]
    assert spark.table(f"{database}.payments").first().notes == "two\nlines, one cell"
    put(tmp_path, "2024-01-04", "e")
    gone = tmp_path / "payments" / "2024-01-01"
    gone.rename(tmp_path / "moved")
    assert ids(spark, database, "run_date = DATE'2024-01-04'") == []
    assert catalog.crawl(spark, str(tmp_path), database)["payments"] == ([day(4)], [day(1)])
    assert ids(spark, database) == [(day(2), "c"), (day(3), "d"), (day(4), "e")]
    assert catalog.crawl(spark, str(tmp_path), database)["payments"] == ([], [])
    known = [tuple(r) for r in catalog.known_partitions(spark, database).collect()]
    assert known == [("payments", day(2)), ("payments", day(3)), ("payments", day(4))]


def test_a_filter_on_the_date_reads_that_date_only(spark, tmp_path, database):
    put(tmp_path, "2024-01-01", "a")
    broken = put(tmp_path, "2024-01-02", "b")
    catalog.crawl(spark, str(tmp_path), database)
    broken.write_text("other,header\n1,2\n")
    assert ids(spark, database, "run_date = DATE'2024-01-01'") == [(day(1), "a")]
    with pytest.raises(Exception, match="(?i)header"):
        ids(spark, database)


def test_two_folders_of_one_date_are_an_error(spark, tmp_path, database):
    put(tmp_path, "2024-01-01", "a")
    put(tmp_path, "run_date=2024-01-01", "b")
    with pytest.raises(ValueError, match="more than one folder"):
        catalog.crawl(spark, str(tmp_path), database)


def test_flat_prefixes(spark, tmp_path, database):
    for name, layout in FLAT.items():
        folder = tmp_path / name
        folder.mkdir()
        (folder / "part.csv").write_text(",".join(layout) + "\n" + ",".join("7" for _ in layout) + "\n")
    catalog.flat_prefixes(spark, str(tmp_path), database)
    for name, layout in FLAT.items():
        assert [tuple(r) for r in spark.table(f"{database}.{name}").collect()] == [("7",) * len(layout)]


def test_readers_may_split_files(spark, tmp_path):
    for name, layout in FLAT.items():
        (tmp_path / f"{name}.csv").write_text(",".join(layout) + "\n" + ",".join("7" for _ in layout) + "\n")
    assert all(t.count() == 1 for t in load_flat_tables(spark, str(tmp_path), multiline=False).values())


@pytest.mark.parametrize("parts", [1, 7])
def test_positions(spark, parts):
    rows = [(i % 5, f"c{i % 3}", i if i % 7 else None) for i in range(200)]
    report = spark.createDataFrame(rows, "risk_score int, customer_id string, total_outstanding int").repartition(6)
    got = outputs.with_positions(report, "customer_risk_summary", parts).collect()
    assert sorted(r.position for r in got) == list(range(1, 201))
    want = sorted(rows, key=lambda r: (-r[0], r[2] is None, -(r[2] or 0), r[1]))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r.position)] == want
    assert outputs.with_positions(report.limit(0), "customer_risk_summary", parts).count() == 0


def test_files_of_a_numbered_report_follow_the_order(spark, tmp_path):
    report = spark.range(1000).selectExpr(
        "concat('m', (id * 37) % 1000) AS match_type", "(id * 7919) % 83 AS payment_count").repartition(5)
    path = outputs.write_report(report, str(tmp_path), "2024-01-01", "recon_dashboard", numbered=True)
    places = []
    for file in sorted(Path(path).glob("part-*")):
        places += [int(r.position) for r in read_csv_text(spark, str(file)).collect()]
    assert places == list(range(1, 1001))
