from collections import defaultdict
from decimal import Decimal

from helpers import star

from starloom.plans import reports

MARKET = [(20240601, 2, 1, 2, 60, 600), (20240601, 2, 2, 2, 40, 400), (20240601, 2, 3, 2, 100, 1000)]


def test_share_is_of_the_therapeutic_market(spark):
    shares = {r.brand_name: r for r in reports.brand_share_mom(star(spark, MARKET)).collect()}
    assert shares["CardioOwn"].share_pct == 60
    assert shares["CardioOwn"].share_delta_pp is None


def test_shares_of_each_market_sum_to_100(spark):
    totals = defaultdict(int)
    for r in reports.brand_share_mom(star(spark, MARKET)).collect():
        totals[r.therapeutic_area] += r.share_pct
    assert totals == {"Cardiology": 100, "Endocrinology": 100}


def test_share_change_is_between_rounded_shares_of_reported_months(spark):
    rx = [(20240531, 1, 1, 1, 1, 1), (20240531, 1, 2, 1, 2, 1), *MARKET]
    own = [r for r in reports.brand_share_mom(star(spark, rx)).collect()
           if r.brand_name == "CardioOwn"]
    assert [(r.share_pct, r.share_delta_pp) for r in own] == [
        (Decimal("33.33"), None), (Decimal("60.00"), Decimal("26.67"))]


def test_zero_market_has_no_share(spark):
    rx = [(20240601, 2, 1, 2, 0, 0)]
    assert reports.brand_share_mom(star(spark, rx)).first().share_pct is None


def test_ranking_leaves_out_competitors_and_shares_ranks(spark):
    versions = [(k, 1, "2024-01-01", "9999-12-31") for k in (1, 2, 3, 4)]
    rx = [(20240601, 1, 1, 1, 5, 1), (20240601, 2, 1, 1, 9, 1), (20240601, 3, 3, 1, 5, 1),
          (20240601, 4, 2, 1, 99, 1)]
    ranked = reports.prescriber_ranking(star(spark, rx, versions=versions)).collect()
    assert [(r.total_trx, r.territory_rank, r.calculated_decile) for r in ranked] == [
        (9, 1, 1), (5, 2, 2), (5, 2, 3)]


def national(spark, **content):
    found = reports.call_effectiveness(star(spark, **content)).collect()
    return [r for r in found if r.stratum == "ALL DECILES"]


def test_call_before_a_transfer_exposes_the_same_person(spark):
    found = national(spark, calls=[(20240531, 1, 1, 1)], rx=[(20240601, 2, 1, 2, 10, 100)])
    assert found[0].cohort == "CALLED"


def test_call_in_the_same_version(spark):
    found = national(
        spark, versions=[(1, 1, "2024-01-01", "2024-04-30"), (2, 2, "2024-05-01", "9999-12-31")],
        calls=[(20240531, 2, 1, 2)], rx=[(20240601, 2, 1, 2, 10, 100)])
    assert found[0].cohort == "CALLED"


def test_two_versions_in_a_month_are_one_person_month(spark):
    found = national(
        spark, versions=[(1, 1, "2024-01-01", "2024-06-14"), (2, 2, "2024-06-15", "9999-12-31")],
        rx=[(20240601, 1, 1, 1, 10, 100), (20240620, 2, 1, 2, 20, 200)])
    assert sum(r.hcp_months for r in found) == 1
    assert found[0].total_trx == 30


def test_competitor_calls_do_not_expose(spark):
    found = national(spark, calls=[(20240531, 1, 2, 1)], rx=[(20240601, 2, 1, 2, 10, 100)])
    assert found[0].cohort == "NOT CALLED"


def test_lift_against_the_uncalled(spark):
    rx = [(20240531, 1, 1, 1, 10, 1), (20240620, 2, 1, 2, 15, 1)]
    rows = {r.cohort: r for r in national(spark, calls=[(20240610, 2, 3, 2)], rx=rx,
                                          extra_days=["2024-06-10"])}
    assert rows["CALLED"].trx_lift_vs_uncalled == 5 and rows["CALLED"].lift_pct == 50
    assert rows["NOT CALLED"].lift_pct == 0
    assert rows["CALLED"].hcps == rows["NOT CALLED"].hcps == 1


QUOTA = [(int(f"2024{m:02d}01"), 1, 1, 1, 1446 if m < 6 else 1445, 100) for m in range(1, 7)]
EARLY = [f"2024-{m:02d}-01" for m in range(1, 6)]


def test_quota_rounds_an_exact_half_up(spark):
    found = reports.territory_attainment(star(spark, QUOTA, extra_days=EARLY)).collect()
    assert len(found) == 6 and {r.target_trx for r in found} == {1562}
    assert {r.plan_status for r in found} == {"BASELINE PERIOD"}


def test_year_to_date_restarts_and_status_steps(spark):
    days = [*EARLY, "2024-07-01", "2024-08-01", "2025-01-01"]
    rx = [*QUOTA, (20240701, 1, 1, 1, 1562, 1), (20240801, 1, 1, 1, 1406, 1),
          (20250101, 1, 1, 1, 1405, 1)]
    found = {r.year_month: r for r in reports.territory_attainment(
        star(spark, rx, extra_days=days)).collect()}
    assert [found[m].plan_status for m in ("2024-07", "2024-08", "2025-01")] == [
        "AT/ABOVE PLAN", "WATCH", "BEHIND PLAN"]
    assert found["2024-07"].ytd_actual_trx == 8675 + 1562
    assert found["2025-01"].ytd_actual_trx == 1405 and found["2025-01"].ytd_target_trx == 1562
    assert found["2024-08"].gap_to_target_trx == -156
    assert found["2024-08"].attainment_pct == Decimal("90.0")


def test_zero_quota_has_no_attainment_and_ranks_first(spark):
    rx = [(20240601, 1, 1, 1, 0, 0), (20240601, 2, 1, 2, 7, 0)]
    found = {r.territory_code: r for r in reports.territory_attainment(star(spark, rx)).collect()}
    assert found["T1"].attainment_pct is None and found["T1"].attainment_rank_in_month == 1
    assert found["T2"].attainment_rank_in_month == 2


def test_query_shapes(spark):
    s = star(spark, MARKET)
    rollup = {(r.year_month, r.brand_name): r.trx for r in reports.monthly_brand_rollup(s).collect()}
    assert rollup["2024-06", "CardioCompetitor"] == 40
    assert [tuple(r) for r in reports.prescriber_drilldown(s, 2).collect()] == [("2024-06", 200)]
