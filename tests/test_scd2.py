import datetime as dt
import random

import pytest
from helpers import OPEN, day, rows

from starloom.operators.scd2 import apply_scd2, scd2_conflicts

SCHEMA = ("hcp_id string, full_name string, specialty string, decile int, territory_key int, "
          "effective_date date, place int")
SHOWN = ("hcp_id", "decile", "territory_key", "valid_from", "valid_to", "is_current")


def change(when="2024-01-01", hcp="HCP-1", name="Dr. A", decile=5, territory=10, place=0):
    return (hcp, name, "Cardiologist", decile, territory, day(when) if when else None, place)


def feed(spark, *changes):
    return spark.createDataFrame(list(changes), SCHEMA)


def fold(spark, existing, *changes):
    return apply_scd2(existing, feed(spark, *changes), ordinal_col="place")


def test_first_load_opens_current_rows(spark):
    assert rows(fold(spark, None, change()), *SHOWN) == [
        ("HCP-1", 5, 10, day("2024-01-01"), OPEN, True)]


def test_tracked_change_closes_and_opens(spark):
    out = fold(spark, fold(spark, None, change()), change("2024-06-01", decile=8))
    assert rows(out, *SHOWN) == [
        ("HCP-1", 5, 10, day("2024-01-01"), day("2024-05-31"), False),
        ("HCP-1", 8, 10, day("2024-06-01"), OPEN, True)]


def test_territory_move(spark):
    out = fold(spark, fold(spark, None, change()), change("2024-04-15", territory=99))
    assert [r.territory_key for r in out.where("is_current").collect()] == [99]
    assert out.count() == 2


def test_untracked_change_and_identical_reload_do_nothing(spark):
    first = fold(spark, None, change())
    renamed = fold(spark, first, change("2024-06-01", name="Dr. B"))
    assert rows(renamed, "full_name", "valid_to") == [("Dr. A", OPEN)]
    assert fold(spark, first, change()).count() == 1


def test_several_changes_in_one_batch(spark):
    out = fold(spark, None, change(), change("2024-03-01", decile=7),
               change("2024-06-01", decile=9), change(hcp="HCP-2"))
    assert out.count() == 4 and out.where("is_current").count() == 2


@pytest.mark.parametrize("first, then", [("2024-01-01", "2024-01-01"), ("2024-06-01", "2024-03-01")])
def test_change_must_be_later_than_the_live_version(spark, first, then):
    existing = fold(spark, None, change(first))
    with pytest.raises(Exception, match="changes twice as of"):
        fold(spark, existing, change(then, decile=7)).collect()


def test_backdated_repeat_of_the_live_values_is_no_change(spark):
    existing = fold(spark, None, change("2024-06-01"))
    assert fold(spark, existing, change("2024-03-01")).count() == 1


def test_null_effective_day_and_inverted_history_are_errors(spark):
    with pytest.raises(Exception, match="is missing in a change of hcp_id"):
        fold(spark, None, change(None)).collect()
    bad = fold(spark, None, change()).selectExpr(
        "hcp_id", "full_name", "specialty", "decile", "territory_key",
        "date'2024-06-01' as valid_from", "date'2024-05-31' as valid_to", "is_current")
    with pytest.raises(Exception, match="before it starts on"):
        fold(spark, bad, change("2024-07-01", decile=1)).collect()


def test_null_equals_null(spark):
    out = fold(spark, None, change(decile=None), change("2024-02-01", decile=None, place=1),
               change("2024-03-01", decile=1, place=2))
    assert rows(out, "decile", "valid_from") == [
        (1, day("2024-03-01")), (None, day("2024-01-01"))]


def test_closed_history_and_keys_pass_through(spark):
    dim = spark.createDataFrame(
        [(1, "H", "n", "s", 1, 1, day("2020-01-01"), day("2020-12-31"), False)],
        "hcp_key int, hcp_id string, full_name string, specialty string, decile int, "
        "territory_key int, valid_from date, valid_to date, is_current boolean")
    out = fold(spark, dim, change("2024-01-01", hcp="H"))
    assert rows(out, "hcp_key", "valid_from", "is_current") == [
        (1, day("2020-01-01"), False), (None, day("2024-01-01"), True)]


def test_same_day_values_switching_back_conflict(spark):
    changes = [change("2024-01-01"), change("2024-02-01", decile=6, place=1),
               change("2024-02-01", place=2), change("2024-02-01", decile=6, place=3)]
    found = scd2_conflicts(None, feed(spark, *changes), ordinal_col="place")
    assert rows(found) == [("HCP-1", day("2024-02-01"))]


def sequential(state, changes):
    """Slow row-at-a-time fold: (rows, conflicting (person, day) pairs)."""
    out = [list(r) for r in state]
    live = {r[0]: r for r in out if r[5]}
    conflicts = set()
    for hcp, decile, territory, when, _ in sorted(changes, key=lambda c: (c[0], c[3], c[4])):
        now = live.get(hcp)
        if now and now[1:3] == [decile, territory]:
            continue
        if now and when <= now[3]:
            conflicts.add((hcp, when))
        if now:
            now[4], now[5] = when - dt.timedelta(days=1), False
        live[hcp] = [hcp, decile, territory, when, OPEN, True]
        out.append(live[hcp])
    return sorted((tuple(r) for r in out), key=repr), conflicts


def random_changes(rng, people, first, last, per_day):
    seen, out = set(), []
    for i in range(600):
        hcp = f"H{min(rng.randrange(people * 2), people)}"
        when = day(first) + dt.timedelta(days=rng.randrange((day(last) - day(first)).days))
        if (hcp, when) in seen and not per_day:
            continue
        seen.add((hcp, when))
        out.append((hcp, rng.randrange(1, 4), rng.randrange(2), when, i))
    return out


def as_feed(spark, changes):
    return feed(spark, *[(h, "n", "s", d, t, w, i) for h, d, t, w, i in changes])


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_a_sequential_fold(spark, seed):
    rng = random.Random(seed)
    first = random_changes(rng, 40, "2024-01-01", "2024-06-01", per_day=False)
    second = random_changes(rng, 50, "2024-06-02", "2024-12-01", per_day=False)
    state = apply_scd2(None, as_feed(spark, first), ordinal_col="place")
    expected, conflicts = sequential([], first)
    assert not conflicts and rows(state, *SHOWN) == expected
    again = apply_scd2(state, as_feed(spark, second), ordinal_col="place")
    expected, conflicts = sequential(expected, second)
    assert not conflicts and rows(again, *SHOWN) == expected


@pytest.mark.parametrize("seed", [3, 4])
def test_same_conflicts_as_a_sequential_fold(spark, seed):
    rng = random.Random(seed)
    first = random_changes(rng, 30, "2024-01-01", "2024-06-01", per_day=False)
    second = random_changes(rng, 30, "2024-05-01", "2024-07-01", per_day=True)
    state, _ = sequential([], first)
    existing = apply_scd2(None, as_feed(spark, first), ordinal_col="place")
    found = scd2_conflicts(existing, as_feed(spark, second), ordinal_col="place")
    _, conflicts = sequential(state, second)
    assert conflicts and rows(found) == sorted(conflicts, key=repr)


def test_first_row_of_a_day_settles_it_when_asked(spark):
    feed = spark.createDataFrame(
        [("A", 5, 1, "2024-01-01", 2), ("A", 4, 1, "2024-01-01", 1), ("A", 4, 1, "2024-02-01", 3),
         ("A", 6, 1, "2024-03-01", 5), ("A", 7, 1, "2024-03-01", 4)],
        "hcp_id string, decile int, territory_key int, effective_date string, line int")
    got = apply_scd2(None, feed, ordinal_col="line", same_day="first").orderBy("valid_from").collect()
    assert [(r["decile"], str(r["valid_from"]), r["is_current"]) for r in got] == [
        (4, "2024-01-01", False), (7, "2024-03-01", True)]
    with pytest.raises(ValueError, match="ordinal_col"):
        apply_scd2(None, feed, same_day="first")
