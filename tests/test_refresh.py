import csv
from decimal import Decimal

import pytest
from helpers import OPEN, day, rows
from pyspark.sql import functions as F

from starloom.operators.coerce import REASON
from starloom.plans import dimensions, refresh, reports
from starloom.schemas import CALL_FEED, HCP_FEED, RX_FEED
from starloom.sources.feeds import MALFORMED, PLACE, read_csv
from starloom.sources import tables
from starloom.sources.tables import Warehouse, append_rows, cluster_fact, slices_per_month

HCP = [
    ("HCP-2", "Dr. B", "GP", "7", "T-002", "2024-01-01"),
    ("HCP-1", "Dr. A", "Cardiologist", "5", "T-001", "2024-01-01"),
    ("HCP-1", "Dr. A", "Cardiologist", "8", "T-003", "2024-03-01"),
    ("HCP-3", "Dr. C", "GP", "11", "T-009", "2024-01-01"),
    ("HCP-4", "Dr. D", "GP", "4", "", "2024-01-01"),
    ("HCP-5", "", "GP", "4", "T-001", "2024-01-01"),
]
RX = [
    ("2024-02-10", "HCP-1", "RX-CARDIO-01", "3", "1", "90.5", "1000.005"),
    ("2024-03-10", "HCP-1", "RX-CARDIO-01", "4", "2", "120", "1200"),
    ("2024-03-10", "HCP-2", "CM-CARDIO-01", "6", "0", "10", "80.10"),
    ("2024-03-11", "HCP-2", "RX-ENDO-01", "N/A", "0", "10", "80"),
    ("2024-03-11", "HCP-2", "UNKNOWN-99", "1", "0", "10", "80"),
    ("2024-02-30", "HCP-2", "RX-ENDO-01", "1", "0", "10", "80"),
    ("2024-03-12", "HCP-3", "RX-ENDO-01", "1", "0", "10", "80"),
    ("2023-12-31", "HCP-2", "RX-ENDO-01", "1", "0", "10", "80"),
    ("2024-03-13", "HCP-2", "RX-ENDO-01", "2", "1", "99999999999", "80"),
]
CALLS = [
    ("2024-02-28", "HCP-1", "RX-CARDIO-01", "DETAIL", "15", "2"),
    ("2024-03-05", "HCP-1", "RX-RESP-01", "VISIT", "15", "2"),
    ("2024-04-30", "HCP-2", "RX-RESP-01", "SAMPLE", "40000", "0"),
]


def write_csv(path, feed, lines, extra=()):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow([c.upper() for c in feed.columns])
        writer.writerows(lines)
        out.writelines(extra)
    return str(path)


@pytest.fixture
def feeds(tmp_path):
    return {
        "hcp": write_csv(tmp_path / "hcp.csv", HCP_FEED, HCP),
        "prescriptions": write_csv(tmp_path / "rx.csv", RX_FEED, RX,
                                   extra=["2024-03-10,HCP-1\n", "a,b,c,d,e,f,g,h\n"]),
        "sales_calls": write_csv(tmp_path / "calls.csv", CALL_FEED, CALLS),
    }


def test_refresh_loads_rejects_and_publishes(spark, feeds, tmp_path):
    root = str(tmp_path / "warehouse")
    stats = refresh.run(spark, feeds, root)
    assert stats["spread"] == {"distinct_deciles": 3, "closed_versions": 1, "distinct_months": 5}
    assert {k: stats[k] for k in stats
            if k not in ("run", "spread", "fact_load_s", "elapsed_s")} == {
        "dim_hcp_rows": 3, "scd2_history_rows": 1, "staged_hcp": 6, "rejected_hcp": 3,
        "staged_rx": 11, "loaded_rx": 3, "rejected_rx": 8,
        "staged_calls": 3, "loaded_calls": 1, "rejected_calls": 2}

    current = Warehouse(spark, root).current()
    assert current.path == stats["run"]
    star = current.star()
    assert rows(star["dim_territory"], "territory_key", "territory_code", "region") == [
        (1, "T-001", "North"), (2, "T-002", "South"), (3, "T-003", "East"), (4, "T-009", "West")]
    assert rows(star["dim_hcp"], "hcp_key", "hcp_id", "decile", "territory_key", "valid_from",
                "valid_to", "is_current") == [
        (1, "HCP-1", 5, 1, day("2024-01-01"), day("2024-02-29"), False),
        (2, "HCP-1", 8, 3, day("2024-03-01"), OPEN, True),
        (3, "HCP-2", 7, 2, day("2024-01-01"), OPEN, True)]
    assert rows(star["fact_prescriptions"]) == [
        (20240210, 1, 1, 1, 3, 1, Decimal("90.50"), Decimal("1000.01"), "2024-02"),
        (20240310, 2, 1, 3, 4, 2, Decimal("120.00"), Decimal("1200.00"), "2024-03"),
        (20240310, 3, 4, 2, 6, 0, Decimal("10.00"), Decimal("80.10"), "2024-03")]
    assert star["dim_date"].count() == 122
    assert star["dim_product"].count() == 8
    assert [r.cohort for r in reports.call_effectiveness(star).collect()
            if r.stratum == "ALL DECILES"] == ["CALLED", "NOT CALLED"]

    rx_rejects = refresh.fact_rejects(current, RX_FEED)
    assert sorted(r[REASON] for r in rx_rejects.collect()) == [
        "malformed line", "malformed line", "no valid HCP version", "non-numeric value in trx_count",
        "out-of-range value in units", "unknown hcp_id", "unknown product_code",
        "unparseable date in rx_date"]
    assert rows(rx_rejects.where(f"{REASON} = 'unknown product_code'"), *RX_FEED.columns) == [RX[4]]
    assert sorted(r[REASON] for r in refresh.all_rejects(current).collect()
                  if r["entity"] != "prescriptions") == [
        "invalid call_type", "missing value in full_name", "out-of-range value in decile",
        "out-of-range value in duration_minutes", "unknown territory_code"]
    exported = refresh.export_rejects(current)
    assert spark.read.option("header", True).csv(exported["prescriptions"]).count() == 8


def test_refresh_twice_gives_the_same_star(spark, feeds, tmp_path):
    root = str(tmp_path / "warehouse")
    first = Warehouse(spark, root)
    refresh.run(spark, feeds, root)
    before = {n: rows(t) for n, t in first.current().star().items()}
    again = refresh.run(spark, feeds, root)
    assert first.current().path == again["run"]
    assert {n: rows(t) for n, t in first.current().star().items()} == before


def test_a_failing_run_is_not_published(spark, feeds, tmp_path):
    root = str(tmp_path / "warehouse")
    # nrx above trx loads, and only the gate sees it
    feeds["prescriptions"] = write_csv(tmp_path / "bad.csv", RX_FEED, [
        ("2024-02-10", "HCP-1", "RX-CARDIO-01", "1", "2", "1", "1"),
        ("2024-02-11", "HCP-1", "RX-CARDIO-01", "1", "0", "1", "1")])
    with pytest.raises(refresh.RefreshError, match="nrx above trx"):
        refresh.run(spark, feeds, root)
    with pytest.raises(LookupError):
        Warehouse(spark, root).current()


def test_a_run_without_facts_is_not_published(spark, feeds, tmp_path):
    feeds["prescriptions"] = write_csv(tmp_path / "none.csv", RX_FEED, RX[3:5])
    with pytest.raises(refresh.RefreshError, match="no prescriptions were loaded"):
        refresh.run(spark, feeds, str(tmp_path / "warehouse"))


def test_conflicting_history_stops_the_run(spark, feeds, tmp_path):
    feeds["hcp"] = write_csv(tmp_path / "bad_hcp.csv", HCP_FEED, [
        HCP[1], (*HCP[1][:3], "6", "T-001", "2024-01-01")])
    with pytest.raises(Exception, match="hcp_id HCP-1 changes twice"):
        refresh.run(spark, feeds, str(tmp_path / "warehouse"))


def test_clean_feeds_leave_header_only_rejects(spark, feeds, tmp_path):
    root = str(tmp_path / "warehouse")
    feeds["sales_calls"] = write_csv(tmp_path / "good_calls.csv", CALL_FEED, CALLS[:1])
    refresh.run(spark, feeds, root)
    path = refresh.export_rejects(Warehouse(spark, root).current())["sales_calls"]
    back = spark.read.option("header", True).csv(path)
    assert back.isEmpty()


def test_csv_is_positional_text(spark, tmp_path):
    path = tmp_path / "rx.csv"
    path.write_text('h\n"2024-01-01","A ""x"", é",P,,"","1\n2",3\nshort,line\n', encoding="utf-8")
    found = read_csv(spark, str(path), RX_FEED).orderBy(PLACE).collect()
    assert found[0][:7] == ("2024-01-01", 'A "x", é', "P", None, "", "1\n2", "3")
    assert [r[MALFORMED] for r in found] == [None, "short,line"]


def test_lost_rows_fail_reconciliation():
    with pytest.raises(refresh.RefreshError, match="reconciliation"):
        refresh.reconcile({"prescriptions": 3}, {"prescriptions": {"loaded": 1, "rejected": 1}})


def test_append_keeps_column_order_and_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a", None)], "x int, y string, z string")
    assert append_rows(df, path, ["y", "x"]) == 1
    assert append_rows(df.limit(0), path, ["y", "x"]) == 0
    assert append_rows(df.union(df), path, ["y", "x"]) == 2
    assert spark.read.parquet(path).columns == ["y", "x"]


def test_totals_of_the_feed_are_loaded_or_rejected(spark, feeds, tmp_path):
    root = str(tmp_path / "warehouse")
    refresh.run(spark, feeds, root)
    current = Warehouse(spark, root).current()
    assert refresh.audit_totals(current).isEmpty()
    assert refresh.audit_totals(current, CALL_FEED).isEmpty()


def test_audit_sees_swapped_rows_that_counts_do_not(spark, feeds, tmp_path):
    root = str(tmp_path / "warehouse")
    refresh.run(spark, feeds, root)
    current = Warehouse(spark, root).current()
    path = current.table("fact_prescriptions")
    stored = spark.read.parquet(path).withColumn(
        "hcp_key", F.when(F.col("hcp_key") == 3, F.lit(2)).otherwise(F.col("hcp_key")))
    damaged = str(tmp_path / "damaged")
    stored.write.partitionBy("outcome", "year_month").parquet(damaged)
    current.table = lambda name, was=current.table: (
        damaged if name == "fact_prescriptions" else was(name))
    found = refresh.audit_totals(current)
    assert rows(found, "hcp_id", "product_code", "rows_diff", "trx_count_diff") == [
        ("HCP-1", "CM-CARDIO-01", -1, -6), ("HCP-2", "CM-CARDIO-01", 1, 6)]


def test_next_batch_extends_the_dimension(spark, feeds, tmp_path):
    root = str(tmp_path / "warehouse")
    refresh.run(spark, feeds, root)
    star = Warehouse(spark, root).current().star()
    batch = spark.createDataFrame(
        [("HCP-1", "Dr. A", "Cardiologist", "9", "T-003", "2024-06-01"),
         ("HCP-2", "Dr. B", "GP", "7", "T-002", "2024-06-01"),
         ("HCP-0", "Dr. Z", "GP", "1", "T-001", "2024-06-01")],
        ", ".join(f"{c} string" for c in HCP_FEED.columns))
    annotated = dimensions.annotate_hcp(batch, star["dim_territory"])
    extended = dimensions.extend_dim_hcp(star["dim_hcp"], annotated)
    assert rows(extended, "hcp_key", "hcp_id", "decile", "valid_from", "valid_to") == [
        (1, "HCP-1", 5, day("2024-01-01"), day("2024-02-29")),
        (2, "HCP-1", 8, day("2024-03-01"), day("2024-05-31")),
        (3, "HCP-2", 7, day("2024-01-01"), OPEN),
        (4, "HCP-0", 1, day("2024-06-01"), OPEN),
        (5, "HCP-1", 9, day("2024-06-01"), OPEN)]


def test_drilldown_reads_only_its_prescriber(spark, feeds, tmp_path):
    root = str(tmp_path / "warehouse")
    refresh.run(spark, feeds, root)
    star = Warehouse(spark, root).current().star()
    drilldown = reports.prescriber_drilldown(star, 3)
    assert rows(drilldown) == [("2024-03", 6)]
    plan = drilldown._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(hcp_key,3)" in plan and "outcome" in plan.split("PartitionFilters")[1]
    assert "gross_sales" not in plan and "date_key" not in plan


def test_drilldown_by_the_access_path_reads_one_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "KEYS_PER_SLICE", 10)
    folder = str(tmp_path / "path")
    facts = spark.range(3000).select(
        (F.col("id") % 300 + 1).alias("hcp_key"),
        F.concat(F.lit("2024-0"), F.col("id") % 7 + 1).alias("year_month"),
        F.col("id").alias("trx_count"))
    tables.write_by_prescriber(facts, folder)
    assert len(spark.read.parquet(folder).inputFiles()) >= 30
    for key in (1, 10, 11, 42, 300):
        found = tables.read_prescriber(spark, folder, key)
        assert len(found.inputFiles()) == 1
        assert rows(found) == rows(facts.where(F.col("hcp_key") == key).groupBy(
            "hcp_key", "year_month").agg(F.sum("trx_count").alias("trx")))
    assert tables.read_prescriber(spark, folder, 301).isEmpty()


def test_stored_drilldown_equals_the_report(spark, feeds, tmp_path):
    root = str(tmp_path / "warehouse")
    refresh.run(spark, feeds, root)
    run = Warehouse(spark, root).current()
    for key in (1, 2, 3, 99):
        assert rows(reports.stored_drilldown(run, key)) == rows(
            reports.prescriber_drilldown(run.star(), key))


def test_layout_gathers_prescribers_and_splits_hot_groups(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        fact = spark.range(60000, numPartitions=8).select(
            (F.col("id") % 1000 + 1).alias("hcp_key"), F.lit(20240101).alias("date_key"),
            F.when(F.col("id") % 3 == 0, "2024-01").otherwise(
                F.concat(F.lit("2024-1"), F.col("id") % 3)).alias("year_month"))
        path = str(tmp_path / "fact")
        cluster_fact(fact, 1000, 3, 4).write.partitionBy("year_month").parquet(path)
        files = spark.read.parquet(path).groupBy("year_month", F.input_file_name().alias("f")).agg(
            F.min("hcp_key").alias("low"), F.max("hcp_key").alias("high"), F.count("*").alias("n"))
        found = files.collect()
        assert sum(r.n for r in found) == 60000
        assert len(found) > 3 and any(r.high - r.low < 500 for r in found)
        assert slices_per_month(10**12, 100) == 1000 and slices_per_month(5, 0) == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_blank_lines_are_counted_and_quarantined(spark, feeds, tmp_path):
    plain = refresh.run(spark, feeds, str(tmp_path / "plain"))
    with open(feeds["prescriptions"], "a", encoding="utf-8") as out:
        out.write("\n   \n\t\n")
    root = str(tmp_path / "blank")
    stats = refresh.run(spark, feeds, root)
    assert stats["staged_rx"] == plain["staged_rx"] + 3
    rejects = refresh.all_rejects(Warehouse(spark, root).current())
    assert rejects.where(F.col(REASON) == "malformed line").where(
        F.trim(F.translate(MALFORMED, "\t", " ")) == "").count() == 3
