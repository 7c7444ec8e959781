"""CSV feeds: records over several lines and blocks, quoting, and what is quarantined."""

import csv
import io
import random

import pytest

from starloom.schemas import CALL_FEED
from starloom.sources import feeds
from starloom.sources.feeds import PLACE, read_csv, stage_feed

N = len(CALL_FEED.columns)


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for name in names:
        spark.conf.set(name, "4000")
    yield
    for name in names:
        spark.conf.unset(name)


def records(spark, path):
    found = read_csv(spark, str(path), CALL_FEED).orderBy(PLACE)
    return [tuple(r)[:N + 1] for r in found.collect()]


def by_csv_module(text):
    """Well-formed records as (fields, None); an unquoted empty field cannot be told from a quoted
    one, so both come as an empty text."""
    body = text[text.index("\n") + 1:]
    return [tuple(r) for r in csv.reader(io.StringIO(body, newline=""))]


@pytest.mark.parametrize("seed", range(2))
def test_quoted_breaks_across_blocks(spark, tmp_path, small_blocks, seed):
    rng = random.Random(seed)
    words = ["a", "two words", 'quo"te', "com,ma", "line\nbreak", "x\n\n\ny", '"', '""', "é\n,", ""]
    path = tmp_path / "feed.csv"
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(CALL_FEED.columns)
        for k in range(300):
            row = [str(k), *[rng.choice(words) for _ in range(N - 1)]]
            if k % 7 == 0:
                row[1] = "word\n" * rng.randrange(60)  # over several blocks
            writer.writerow(row)
    expected = by_csv_module(path.read_text(encoding="utf-8"))
    assert len(expected) == 300 and any("\n" in f for r in expected for f in r)
    found = records(spark, path)
    assert [tuple(c or "" for c in r[:N]) for r in found] == expected
    assert all(r[N] is None for r in found)
    assert stage_feed(spark, str(path), CALL_FEED, str(tmp_path / "staged")) == 300


def test_files_are_read_once(spark, tmp_path, small_blocks, monkeypatch):
    path = tmp_path / "feed.csv"
    path.write_text("h\n" + '1,"a\nb",c,d,e,f\n' * 50)
    reads = []
    kind = type(spark.read)
    monkeypatch.setattr(kind, "text", lambda self, *a, was=kind.text: reads.append(a) or was(self, *a))
    monkeypatch.setattr(kind, "csv", lambda self, *a: reads.append(a))
    staged = str(tmp_path / "staged")
    assert stage_feed(spark, str(path), CALL_FEED, staged) == 50
    path.unlink()
    assert feeds.read_staged(spark, staged).count() == 50
    assert len(reads) == 1


def test_quoted_empty_text_is_no_missing_one(spark, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text('"head\n1,"",,"""",a b,\n', encoding="utf-8")
    assert records(spark, path) == [("1", "", None, '"', "a b", None, None)]


def test_bad_lines_are_quarantined_and_counted(spark, tmp_path):
    path = tmp_path / "feed.csv"
    lines = ["1,2,3,4,5,6", "short", "", "  ", "1,2,3,4,5,6,7", '1,2"3,4,5",6,7,8', '1,"2"3,4,5,6,7',
             '1,"a,b",3,4,5,6', '1,"open,3,4,5,6', "7,8,9,10,11,12"]
    path.write_text("\n".join(["h", *lines]) + "\n")
    staged = str(tmp_path / "staged")
    assert stage_feed(spark, str(path), CALL_FEED, staged) == len(lines)
    found = records(spark, path)
    assert [r[N] for r in found] == [
        None, *lines[1:7], None, lines[8], None]
    assert found[7][1] == "a,b" and found[9][0] == "7"


def test_far_quotes_do_not_swallow_the_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feeds, "MOST_LINES", 5)
    path = tmp_path / "feed.csv"
    lines = ['"stray,2,3,4,5,6', *["1,2,3,4,5,6"] * 20, '1,2,3,4,5,stray"', '"a\nb",2,3,4,5,6']
    path.write_text("\n".join(["h", *lines]) + "\n")
    found = records(spark, path)
    assert len(found) == 23
    assert [r[N] for r in found if r[N]] == [lines[0], lines[21]]
    assert found[-1][0] == "a\nb"


def test_several_files_each_with_a_header(spark, tmp_path, small_blocks):
    folder = tmp_path / "feed"
    folder.mkdir()
    for k in range(3):
        body = "".join(f'{k}{i},"x\r\ny",3,4,5,6\r\n' for i in range(9))
        (folder / f"part{k}.csv").write_bytes(("a,b\r\n" + body).encode())
    (folder / "none.csv").write_text("")
    (folder / "header.csv").write_text("only a header")
    found = records(spark, folder)
    assert sorted(r[0] for r in found) == [f"{k}{i}" for k in range(3) for i in range(9)]
    assert {r[1] for r in found} == {"x\ny"}


def test_only_the_text_of_broken_lines_moves(spark, tmp_path):
    """Lines that stay out are marked by bits, and records sewn together keep no second copy."""
    path = tmp_path / "feed.csv"
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(CALL_FEED.columns)
        writer.writerows([f"{i}\nx\ny", *["v"] * (N - 1)] for i in range(200))
    assert stage_feed(spark, str(path), CALL_FEED, str(tmp_path / "staged")) == 200
    assert spark.read.parquet(str(tmp_path / "staged" / "taken")).count() == 10  # 601 lines, 64 to a row
    assert feeds.QUOTED not in spark.read.parquet(str(tmp_path / "staged" / "sewn")).columns
    assert feeds.read_staged(spark, str(tmp_path / "staged")).count() == 200
