"""Registered queries against their SQL on the smallest tables, and the plans they run."""

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from starloom.oracle import ORACLE_SQL
from starloom.queries import _rx_annotated, registered

DATA = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{DATA}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def test_every_query_has_its_sql():
    assert set(registered()) == set(ORACLE_SQL)
    assert set(registered()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(registered()))
def test_same_rows_as_sql(spark, duck, name):
    mine = contract.queries()[name](spark, DATA)
    columns = sorted(mine.columns)
    other = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in other.description]
    assert sorted(names) == columns
    place = [names.index(c) for c in columns]
    expected = sorted((tuple(plain(r[i]) for i in place) for r in other.fetchall()), key=repr)
    found = sorted((tuple(plain(r[c]) for c in columns) for r in mine.collect()), key=repr)
    assert found == expected


@pytest.mark.parametrize("name", sorted(registered()))
def test_plans_stay_distributed_and_in_the_jvm(spark, name):
    plan = contract.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def physical_plan(spark, name):
    return contract.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_what_the_query_needs(spark):
    plan = physical_plan(spark, "monthly_brand_rollup")
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan
    assert "customer.parquet" not in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_brand:string>" in plan


def test_filters_reach_the_scans(spark):
    assert "EqualTo(o_custkey,742)" in physical_plan(spark, "prescriber_drilldown")
    plan = physical_plan(spark, "exposure_days")
    assert "EqualTo(event_type,purchase)" in plan and "EqualTo(event_type,click)" in plan


def test_exposure_joins_nothing_and_history_shuffles_once_per_step(spark):
    assert "Join" not in physical_plan(spark, "exposure_days")
    # one to reduce to a row per day, one to bring a person together
    assert physical_plan(spark, "scd2_versions").count("Exchange hashpartitioning") == 2


ORDERS = {
    "brand_share_mom": ("year_month, therapeutic_area, share_pct DESC NULLS FIRST, brand_name",
                        ("year_month", "therapeutic_area", "share_pct", "brand_name")),
    "prescriber_ranking": ("territory_name, territory_rank", ("territory_name", "territory_rank")),
    "territory_attainment": ("year_month, attainment_pct NULLS LAST, territory_code",
                             ("year_month", "attainment_pct", "territory_code")),
    "call_effectiveness": ("stratum = 'ALL DECILES' DESC, stratum, cohort", ("stratum", "cohort")),
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_reports_come_in_order(spark, duck, name):
    by, columns = ORDERS[name]
    other = duck.execute(f"select {', '.join(columns)} from ({ORACLE_SQL[name]}) order by {by}")
    expected = [tuple(map(plain, r)) for r in other.fetchall()]
    found = [tuple(plain(r[c]) for c in columns) for r in registered()[name](spark, DATA).collect()]
    assert found == expected


@pytest.mark.parametrize("query", ["source_vs_warehouse", "source_vs_damaged_warehouse"])
def test_audit_reads_what_the_load_has_written(spark, query):
    read = registered()[query](spark, DATA).inputFiles()
    assert not [f for f in read if "lineitem" in f]


def test_only_text_moves_to_the_dimensions(spark):
    """Typed values are made after the joins, so no shuffle carries them beside their text."""
    _, annotated = _rx_annotated(spark, DATA)
    plan = annotated._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate inline" in plan
    assert plan.index("Generate inline") < plan.index("Join LeftOuter")
