"""Medians by selection and distinct counts by bitmaps against plain ones."""

import random
import statistics

from helpers import rows

from starloom.operators.selection import distinct_ids, medians


def test_medians_of_weighted_groups(spark):
    rng = random.Random(6)
    data, plain = [], {}
    for g in (None, "a", "b", "one", "two"):
        size = {"one": 1, "two": 2}.get(g, 300)
        for _ in range(size):
            v = rng.choice([0, 7, -5, rng.randrange(-2**32, 2**32), rng.randrange(100)])
            w = rng.randrange(4) if size > 2 else 1
            data.append((g, v, w))
            plain.setdefault(g, []).extend([v] * w)
    data += [("a", None, 5), ("none", None, 1)]
    df = spark.createDataFrame(data, "g string, v long, w int").repartition(7)
    found = {r["g"]: (r["low"], r["high"]) for r in medians(df, ["g"], "v", "w").collect()}
    assert found == {g: (statistics.median_low(v), statistics.median_high(v))
                     for g, v in plain.items()}


def test_medians_of_long_values_and_no_rows(spark):
    big = [2**62, -2**62, 2**62 - 1, 5]
    df = spark.createDataFrame([(1, v, 1) for v in big], "g int, v long, w int")
    assert rows(medians(df, ["g"], "v", "w", 64)) == [(1, 5, 2**62 - 1)]
    assert medians(df.limit(0), ["g"], "v", "w").isEmpty()


def test_distinct_ids_of_any_grouping_set(spark):
    rng = random.Random(7)
    data = [(rng.choice(["x", "y", None]), rng.choice([1, 2, None]),
             rng.choice([None, rng.randrange(1, 90_000), 32768, 32769])) for _ in range(3000)]
    df = spark.createDataFrame(data, "a string, b int, person long")
    plain = {}
    for a, b, p in data:
        if p is not None:
            for key in ((0, a, None), (1, a, b), (2, None, None)):
                plain.setdefault(key, set()).add(p)
    found = distinct_ids(df, "person", [["a"], ["a", "b"], []])
    assert sorted(map(tuple, found.select("set_id", "a", "b", "ids").collect()), key=repr) == sorted(
        ((*k, len(v)) for k, v in plain.items()), key=repr)
