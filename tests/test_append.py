"""Further batches against a refresh over everything, and what readers and failures see."""

import csv
import random

import pytest
from helpers import rows

from starloom.plans import append as appending
from starloom.plans import refresh, reports
from starloom.plans.append import append
from starloom.schemas import CALL_FEED, CALL_TYPES, FEEDS, HCP_FEED, PRODUCTS, RX_FEED
from starloom.sources.tables import Warehouse
from starloom.streaming.follow import follow, publish_batch


def write_feed(path, feed, lines):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(feed.columns)
        writer.writerows(lines)
    return str(path)


def write_feeds(folder, hcp, rx, calls):
    folder.mkdir(exist_ok=True)
    return {f.name: write_feed(folder / f"{f.name}.csv", f, lines)
            for f, lines in zip(FEEDS, (hcp, rx, calls), strict=True)}


def history(rng, people, changes):
    seen, out = set(), []
    for p in people:
        for k in range(changes):
            day = "2024-01-01" if k == 0 else f"2024-{rng.randrange(1, 7):02d}-{rng.randrange(2, 29):02d}"
            if (p, day) not in seen:
                seen.add((p, day))
                out.append((f"H{p}", f"Dr {p}", "GP", str(rng.randrange(1, 4)),
                            f"T-00{rng.randrange(1, 4)}", day))
    return out


def facts(rng, people, n, months):
    grain, out = set(), []
    for _ in range(n):
        p, code = rng.choice(people), rng.choice(PRODUCTS)[0]
        day = f"2024-{rng.choice(months):02d}-{rng.randrange(1, 29):02d}"
        if (p, code, day) not in grain:
            grain.add((p, code, day))
            trx = str(rng.choice([3, 4, 5, "N/A"]))
            out.append((day, f"H{p}", code, trx, "1", "2.5", "10.25"))
    return out


def calls(rng, people, n, months):
    return [(f"2024-{rng.choice(months):02d}-{rng.randrange(1, 29):02d}", f"H{rng.choice(people)}",
             rng.choice(PRODUCTS)[0], rng.choice(CALL_TYPES), "15", "1") for _ in range(n)]


def natural(run):
    """Facts, versions and rejects without surrogate keys."""
    star = run.star()
    people = star["dim_hcp"].join(
        star["dim_territory"].select("territory_key", "territory_code"), "territory_key")
    version = people.select("hcp_key", "hcp_id", "valid_from", "valid_to", "decile",
                            "territory_code", "is_current")
    out = {"versions": rows(version.drop("hcp_key"))}
    codes = star["dim_product"].select("product_key", "product_code")
    places = star["dim_territory"].select("territory_key", "territory_code")
    for feed in (RX_FEED, CALL_FEED):
        fact = star[feed.target]
        out[feed.name] = rows(
            fact.join(version.select("hcp_key", "hcp_id", "valid_from"), "hcp_key")
            .join(codes, "product_key").join(places, "territory_key")
            .select("hcp_id", "valid_from", "product_code", "territory_code", "date_key",
                    *feed.measures))
        assert len(out[feed.name]) == fact.count()
        if feed is RX_FEED:
            for key in [r["hcp_key"] for r in version.orderBy("hcp_key").limit(2).collect()]:
                assert rows(reports.stored_drilldown(run, key)) == rows(
                    reports.prescriber_drilldown(star, key))
        out[f"{feed.name} rejects"] = rows(refresh.fact_rejects(run, feed))
    out["days"] = star["dim_date"].count()
    return out


@pytest.mark.parametrize("seed", [1])
def test_batches_with_corrections_equal_one_refresh(spark, tmp_path, seed):
    """Changes arrive in any order, so the second batch corrects the past of the first."""
    rng = random.Random(seed)
    hcp = history(rng, range(8), 4)
    rx, visits = facts(rng, range(10), 160, [1, 2, 3, 4, 5, 6]), calls(rng, range(9), 40, [2, 3])
    first = [r for r in hcp if r[5] == "2024-01-01" and r[0] != "H7"]
    rest = [r for r in hcp if r not in first]
    rng.shuffle(rest)
    cut = len(rest) // 2
    root, whole = str(tmp_path / "steps"), str(tmp_path / "whole")
    refresh.run(spark, write_feeds(tmp_path / "1", first + rest[:cut], rx[:90], visits[:20]), root)
    warehouse = Warehouse(spark, root)
    before = rows(warehouse.current().read(RX_FEED.target))
    stats = append(spark, write_feeds(tmp_path / "2", rest[cut:], rx[90:], visits[20:]), root)
    assert stats["version"] == 2
    refresh.run(spark, write_feeds(tmp_path / "3", hcp, rx, visits), whole)
    found, expected = natural(warehouse.current()), natural(Warehouse(spark, whole).current())
    assert found == expected
    assert rows(warehouse.version(1).read(RX_FEED.target)) == before


def test_only_touched_months_are_written(spark, tmp_path):
    rng = random.Random(3)
    hcp = history(rng, range(5), 1)
    root = str(tmp_path / "w")
    start = write_feeds(tmp_path / "1", hcp, facts(rng, range(5), 60, [1, 2, 3, 4]), [])
    refresh.run(spark, start, root)
    warehouse = Warehouse(spark, root)
    keys = {r["hcp_id"]: r["hcp_key"] for r in warehouse.current().star()["dim_hcp"].collect()}
    stats = append(spark, {"prescriptions": write_feed(
        tmp_path / "rx.csv", RX_FEED, [("2024-03-30", "H1", "RX-ENDO-01", "2", "1", "1", "1")])},
        root, "a")
    old, new = warehouse.version(1), warehouse.current()
    months = {m: f for t, m, f in new.entries if t == RX_FEED.target}
    assert set(months) == {"2024-01", "2024-02", "2024-03", "2024-04", "none"}
    for month, folder in months.items():
        assert folder == (new if month in ("2024-03", "none") else old).table(RX_FEED.target)
    stored = spark.read.parquet(new.table(RX_FEED.target))
    assert {r[0] for r in stored.where("outcome = 'loaded'").select("year_month").distinct()
            .collect()} == {"2024-03"}
    assert stats["prescriptions"]["loaded"] == old.read(RX_FEED.target).count() + 1
    assert {r["hcp_id"]: r["hcp_key"] for r in new.star()["dim_hcp"].collect()} == keys
    # the same batch once more changes nothing
    assert append(spark, {}, root, "a") == {"published": False}
    assert warehouse.latest()[0] == 2


def test_rejected_lines_load_once_their_prescriber_is_known(spark, tmp_path):
    root = str(tmp_path / "w")
    known = ("H1", "Dr 1", "GP", "2", "T-001", "2024-01-01")
    rx = [("2024-02-01", h, "RX-ENDO-01", "2", "1", "1", "1") for h in ("H1", "H2")]
    refresh.run(spark, write_feeds(tmp_path / "1", [known], rx, []), root)
    warehouse = Warehouse(spark, root)
    assert refresh.fact_rejects(warehouse.current(), RX_FEED).count() == 1
    append(spark, {"hcp": write_feed(tmp_path / "h.csv", HCP_FEED, [("H2", *known[1:])])}, root)
    assert refresh.fact_rejects(warehouse.current(), RX_FEED).isEmpty()
    assert warehouse.current().read(RX_FEED.target).count() == 2
    assert refresh.fact_rejects(warehouse.version(1), RX_FEED).count() == 1


def test_a_failed_batch_leaves_no_version(spark, tmp_path):
    root = str(tmp_path / "w")
    hcp = [("H1", "Dr 1", "GP", "2", "T-001", "2024-01-01")]
    line = ("2024-02-01", "H1", "RX-ENDO-01", "2", "1", "1", "1")
    refresh.run(spark, write_feeds(tmp_path / "1", hcp, [line], []), root)
    warehouse = Warehouse(spark, root)
    before = natural(warehouse.current())
    again = {"prescriptions": write_feed(tmp_path / "again.csv", RX_FEED, [line])}
    with pytest.raises(refresh.RefreshError, match="grain is repeated"):
        append(spark, again, root, "x")
    assert warehouse.latest()[0] == 1 and not warehouse.holds("x")
    assert natural(warehouse.current()) == before
    # two runs from the same version: the second may not take the number of the first
    number = warehouse.publish(warehouse.current())
    warehouse._latest = lambda: number - 1
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        warehouse.publish(warehouse.version(number))


def test_streamed_deliveries_are_published_once(spark, tmp_path, monkeypatch):
    root, landing = str(tmp_path / "w"), tmp_path / "landing"
    landing.mkdir()
    hcp = [("H1", "Dr 1", "GP", "2", "T-001", "2024-01-01")]
    line = ("2024-02-01", "H1", "RX-ENDO-01", "2", "1", "1", "1")
    refresh.run(spark, write_feeds(tmp_path / "1", hcp, [line], []), root)
    warehouse = Warehouse(spark, root)

    def deliver(name, day):
        write_feed(landing / name, HCP_FEED, [("H1", "Dr\n1", "GP", "3", "T-002", day)])

    def run():
        stream = follow(spark, str(landing), HCP_FEED, root, str(tmp_path / "checkpoint"), 1)
        stream.awaitTermination(120)

    deliver("a.csv", "2024-01-15")
    # killed between write and publication: nothing is seen, and the batch starts over
    with monkeypatch.context() as broken:
        broken.setattr(Warehouse, "publish", lambda *_: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(Exception, match="killed"):
            run()
    assert warehouse.latest()[0] == 1
    run()
    assert warehouse.latest()[0] == 2
    seen = natural(warehouse.current())
    assert [v[0] for v in seen["versions"]] == ["H1", "H1"]
    assert seen["prescriptions"][0][3] == "T-002"
    # the same micro-batch once more
    lines = spark.createDataFrame([], "value string, file string, block long")
    batch = spark.read.parquet(f"{root}/published").where("version = 2").first()["batch"]
    assert publish_batch(lines, HCP_FEED, root, batch) == {"published": False}
    assert warehouse.latest()[0] == 2
    assert appending.append(spark, {}, root, batch) == {"published": False}
