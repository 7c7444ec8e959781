from decimal import Decimal

from helpers import day, rows, star

from starloom.operators import quality


def versions(spark, *spans):
    return spark.createDataFrame(
        [(i, h, day(a), day(z), c) for i, (h, a, z, c) in enumerate(spans)],
        "hcp_key int, hcp_id string, valid_from date, valid_to date, is_current boolean")


def test_orphans_per_key_in_one_scan(spark):
    fact = spark.createDataFrame([(1, 10), (1, 99), (2, 99), (None, 10)], "a int, b int")
    dims = {"a": spark.createDataFrame([(1,)], "a int"), "b": spark.createDataFrame([(10,)], "b int")}
    assert rows(quality.orphans({"f": fact}, dims, {"f": ("a", "b")})) == [
        ("f.a has no dimension row", 2), ("f.b has no dimension row", 2)]


def test_child_of_an_existing_parent_passes(spark):
    parent = spark.createDataFrame([(1,)], "id int")
    check = lambda rows: quality.failed(
        quality.orphans({"child": rows}, {"id": parent}, {"child": ("id",)}))
    assert check(parent) == []
    assert check(spark.createDataFrame([(999,)], "id int")) == [
        ("child.id has no dimension row", 1)]


def test_repeated_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "b")], "k int, c string")
    assert rows(quality.repeated_keys({"t": df}, {"t": ("k", "c")})) == [
        ("t.c is repeated", 1), ("t.k is repeated", 0)]


def test_overlapping_pairs_are_counted(spark):
    dim = versions(
        spark, ("A", "2024-01-01", "2024-01-31", False), ("A", "2024-01-31", "9999-12-31", True),
        ("A", "2024-01-31", "2024-03-01", False), ("B", "2024-01-01", "2024-01-31", False),
        ("B", "2024-02-01", "9999-12-31", True))
    assert rows(quality.overlapping_versions(dim)) == [("pairs of overlapping versions", 3)]


def test_current_rows(spark):
    dim = versions(spark, ("A", "2024-01-01", "2024-01-31", True),
                   ("A", "2024-02-01", "9999-12-31", True),
                   ("B", "2024-01-01", "9999-12-31", False), ("C", "2024-01-01", "9999-12-31", True))
    assert rows(quality.not_one_current(dim)) == [("people without exactly one current version", 2)]


def test_inverted_window_is_a_violation(spark):
    dim = versions(spark, ("A", "2024-06-01", "2024-05-31", False)).selectExpr(
        "*", "'n' full_name", "'s' specialty", "11 decile", "1 territory_key")
    found = dict(rows(quality.count_rows_where(dim, quality.row_conditions("dim_hcp"))))
    assert found["dim_hcp has an inverted window"] == 1
    assert found["dim_hcp has a decile outside 1..10"] == 1


def test_fact_rows(spark):
    fact = spark.createDataFrame(
        [(1, 1, 1, 1, 1, 2, Decimal("1"), Decimal("1")),
         (1, 1, 1, 1, 1, 1, Decimal("-1"), None)],
        "date_key int, hcp_key int, product_key int, territory_key int, trx_count int, "
        "nrx_count int, units decimal(12,2), gross_sales decimal(14,2)")
    found = dict(rows(quality.count_rows_where(fact, quality.row_conditions("fact_prescriptions"))))
    assert {k: v for k, v in found.items() if v} == {
        "fact_prescriptions.gross_sales is null": 1,
        "fact_prescriptions has a negative measure": 1,
        "fact_prescriptions has nrx above trx": 1}


def test_facts_outside_their_version(spark):
    s = star(spark, rx=[(20240531, 1, 1, 1, 1, 1), (20240601, 1, 1, 1, 1, 1),
                        (20240531, 2, 1, 2, 1, 1)])
    found = quality.facts_outside_version(
        {"rx": s["fact_prescriptions"]}, s["dim_hcp"], s["dim_date"])
    assert [r.violations for r in found.collect()] == [2]


def test_differing_totals(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1), ("z", 0)], "k string, m int")
    b = spark.createDataFrame([("x", 3), ("y", 1)], "k string, m int")
    assert rows(quality.differing_totals(a, b, ["k"], ["m"])) == [("x", 1, 0), ("z", 1, 0)]
    assert quality.differing_totals(a, a, ["k"], ["m"]).isEmpty()


def test_distribution(spark):
    dim = spark.createDataFrame([(1, True), (2, False), (2, True), (None, True)],
                                "decile int, is_current boolean")
    s = star(spark)
    assert rows(quality.distribution(dim, s["dim_date"])) == [
        ("closed_versions", 1, True), ("distinct_deciles", 2, False), ("distinct_months", 2, False)]


def test_facts_meet_their_versions_uncounted(spark):
    """Facts are not gathered per (version, day) before the join, where nearly each is its own group."""
    dim = versions(spark, ("A", "2024-01-01", "2024-01-31", False))
    days = spark.createDataFrame([(20240105, day("2024-01-05")), (20240205, day("2024-02-05"))],
                                 "date_key int, full_date date")
    facts = spark.createDataFrame([(0, 20240105), (0, 20240205), (0, 20240205)],
                                  "hcp_key int, date_key int")
    found = quality.facts_outside_version({"rx": facts, "calls": facts.limit(1)}, dim, days)
    assert dict(rows(found))["rx rows outside their version's window"] == 2
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
