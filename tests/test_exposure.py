import datetime as dt
import random

import pytest
from helpers import day, rows

from starloom.operators.exposure import person_days, prior_calls_by_range_join, with_prior_calls


def frames(spark, scripts, calls):
    return (spark.createDataFrame(scripts, "hcp_id string, day date, trx int"),
            spark.createDataFrame(calls, "hcp_id string, day date"))


def test_same_day_is_out_and_day_14_is_in(spark):
    start = day("2024-01-01")
    scripts = [("H", start + dt.timedelta(days=i), 1) for i in range(20)]
    counted = with_prior_calls(person_days(*frames(
        spark, scripts, [("H", start + dt.timedelta(days=2))])))
    seen = {(r.day - start).days: r.prior_calls for r in counted.collect()}
    assert seen[2] == 0 and seen[3] == 1 and seen[16] == 1 and seen[17] == 0


@pytest.mark.parametrize("seed", [7, 8])
def test_window_and_range_join_match_every_pair(spark, seed):
    rng = random.Random(seed)
    start = day("1969-12-01")
    pick = lambda: (f"H{min(rng.randrange(12), 6)}", start + dt.timedelta(days=rng.randrange(120)))
    scripts = [(*pick(), rng.randrange(5)) for _ in range(400)]
    calls = [pick() for _ in range(120)]
    totals = {}
    for h, d, t in scripts:
        totals[h, d] = totals.get((h, d), 0) + t
    expected = sorted([
        (h, d, t, sum(1 for ch, cd in calls if ch == h and 1 <= (d - cd).days <= 14))
        for (h, d), t in totals.items()], key=repr)
    rx, contacts = frames(spark, scripts, calls)
    assert rows(with_prior_calls(person_days(rx, contacts))) == expected
    assert rows(prior_calls_by_range_join(rx, contacts)) == expected
