import datetime as dt
import random

import pytest
from helpers import OPEN, day, rows

from starloom.operators.calendar import build_dim_date
from starloom.operators.coerce import REASON
from starloom.operators.resolve import resolve_surrogate_keys, version_segments

HCP_SCHEMA = "hcp_id string, hcp_key int, territory_key int, valid_from date, valid_to date"
WHOLE = [("HCP-1", 1, 10, "2024-01-01", "2024-05-31"), ("HCP-1", 2, 20, "2024-06-01", "9999-12-31")]
GAPS = [("HCP-1", 1, 10, "2024-02-01", "2024-04-30"), ("HCP-1", 2, 20, "2024-06-01", "9999-12-31")]


def hcp(spark, versions):
    return spark.createDataFrame([(*v[:3], day(v[3]), day(v[4])) for v in versions], HCP_SCHEMA)


def resolve(spark, facts, versions=WHOLE, products=(("RX-1", 7),)):
    rx = spark.createDataFrame(
        [(d, h, p, i) for i, (d, h, p) in enumerate(facts)],
        "rx_date string, hcp_id string, product_code string, trx_count int")
    dim_product = spark.createDataFrame(list(products), "product_code string, product_key int")
    return resolve_surrogate_keys(rx, hcp(spark, versions), dim_product,
                                  build_dim_date(spark, "2024-01-01", "2024-12-31"))


def test_facts_take_the_version_of_their_day(spark):
    good, bad = resolve(spark, [("2024-03-04", "HCP-1", "RX-1"), ("2024-08-04", "HCP-1", "RX-1")])
    assert good.columns == ["trx_count", "date_key", "hcp_key", "product_key", "territory_key"]
    assert rows(good) == [(0, 20240304, 1, 7, 10), (1, 20240804, 2, 7, 20)]
    assert bad.isEmpty()


@pytest.mark.parametrize("fact, versions, reason", [
    (("2024-03-04", "HCP-1", "NOPE"), WHOLE, "unknown product_code"),
    (("2024-03-04", "GHOST", "RX-1"), WHOLE, "unknown hcp_id"),
    (("2024-03-04", "GHOST", "NOPE"), WHOLE, "unknown product_code"),
    (("2024-03-04", None, "RX-1"), WHOLE, "unknown hcp_id"),
    (("2024-01-15", "HCP-1", "RX-1"), GAPS, "no valid HCP version"),
    (("2024-05-15", "HCP-1", "RX-1"), GAPS, "no valid HCP version"),
    ((None, "HCP-1", "RX-1"), WHOLE, "missing or invalid rx_date"),
    (("2024-02-30", "GHOST", "NOPE"), WHOLE, "missing or invalid rx_date"),
    (("2025-01-01", "HCP-1", "RX-1"), WHOLE, "date outside dim_date"),
    (("2024-03-01", "HCP-1", "RX-1"), [*GAPS, ("HCP-1", 99, 10, "2024-02-01", "2024-04-30")],
     "overlapping HCP versions"),
])
def test_reject_reasons(spark, fact, versions, reason):
    good, bad = resolve(spark, [fact], versions)
    assert good.isEmpty()
    assert rows(bad) == [(*fact, 0, reason)]


def test_transfer_assigns_both_territories(spark):
    good, bad = resolve(spark, [("2024-03-01", "HCP-1", "RX-1"), ("2024-07-01", "HCP-1", "RX-1")],
                        GAPS)
    assert [r[1] for r in rows(good, "date_key", "territory_key")] == [10, 20] and bad.isEmpty()


def test_the_faulty_rows_are_the_rejected_ones(spark):
    facts = [("2024-03-01", "HCP-1", "RX-1"), ("2024-03-05", "HCP-1", "BAD"),
             ("2024-03-02", "HCP-1", "RX-1"), ("2024-03-06", "GHOST", "RX-1")]
    good, bad = resolve(spark, facts)
    assert rows(good, "date_key") == [(20240301,), (20240302,)]
    assert rows(bad, "hcp_id", "product_code") == [("GHOST", "RX-1"), ("HCP-1", "BAD")]


def test_repeated_product_code_is_an_error(spark):
    with pytest.raises(ValueError, match="product_code is not unique"):
        resolve(spark, [("2024-03-01", "HCP-1", "RX-1")], products=[("RX-1", 7), ("RX-1", 8)])


def test_stretches_cover_all_time_once(spark):
    stretches = version_segments(hcp(spark, GAPS)).orderBy("seg_from").collect()
    assert stretches[0].seg_from == dt.date(1, 1, 1) and stretches[-1].seg_to == OPEN
    for a, b in zip(stretches, stretches[1:], strict=False):
        assert a.seg_to + dt.timedelta(days=1) == b.seg_from
    assert [s.hcp_key for s in stretches] == [None, 1, None, 2]


@pytest.mark.parametrize("seed", [5, 6])
def test_same_as_looking_at_every_version(spark, seed):
    rng = random.Random(seed)
    start = day("2024-01-01")
    versions = []
    for key in range(1, 120):
        a = start + dt.timedelta(days=rng.randrange(-30, 380))
        z = OPEN if rng.random() < 0.1 else a + dt.timedelta(days=rng.randrange(-3, 60))
        versions.append((f"H{rng.randrange(20)}", key, rng.randrange(5), a, z))
    facts = [((start + dt.timedelta(days=rng.randrange(-10, 400))).isoformat(),
              f"H{min(rng.randrange(44), 22) % 22}", "RX-1") for _ in range(1500)]
    good, bad = resolve(spark, facts, [(*v[:3], v[3].isoformat(), v[4].isoformat())
                                       for v in versions])
    known = {v[0] for v in versions}
    expected_good, expected_bad = {}, {}
    for i, (d, person, _) in enumerate(facts):
        hits = [v for v in versions if v[0] == person and v[3] <= day(d) <= v[4]]
        if person not in known:
            expected_bad[i] = "unknown hcp_id"
        elif len(hits) > 1:
            expected_bad[i] = "overlapping HCP versions"
        elif not hits:
            expected_bad[i] = "no valid HCP version"
        elif not "2024-01-01" <= d <= "2024-12-31":
            expected_bad[i] = "date outside dim_date"
        else:
            expected_good[i] = hits[0][1:3]
    assert {r.trx_count: (r.hcp_key, r.territory_key) for r in good.collect()} == expected_good
    assert {r.trx_count: r[REASON] for r in bad.collect()} == expected_bad
    assert set(expected_bad.values()) == {
        "unknown hcp_id", "overlapping HCP versions", "no valid HCP version",
        "date outside dim_date"}
