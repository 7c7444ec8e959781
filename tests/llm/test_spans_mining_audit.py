"""Substring dedup, hard negatives and the filter audit against brute force."""

from __future__ import annotations

import math
import random
from itertools import permutations

import numpy as np
import pytest

from starloom.llm import filter_audit, hard_negatives, substring_dedup


# ----------------------------------------------------------------- substring dedup
def kept_words(rows):
    """(doc_id, text) -> kept words, by looking at every window of every text."""
    texts = sorted({(r[0], r[1] or "") for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    first, out = {}, {}
    told = {r: r[1].encode().split() for r in texts}
    for row in texts:
        for s in range(len(told[row]) - 19):
            first.setdefault(tuple(told[row][s:s + 20]), (row, s))
    for row in texts:
        gone = set()
        for s in range(len(told[row]) - 19):
            if first[tuple(told[row][s:s + 20])] != (row, s):
                gone |= set(range(s, s + 20))
        out[row] = [w.decode() for k, w in enumerate(told[row]) if k not in gone]
    return out


def spans_of(spark, documents, rows):
    found = substring_dedup.with_factors(documents(rows)).select(
        "row.doc_id", "row.text", "n_words", "n_removed", "kept", "factors").collect()
    expected = kept_words(rows)
    assert len(found) == len(rows)
    for r in found:
        kept = expected[(r["doc_id"], r["text"] or "")]
        assert r["kept"] == " ".join(kept)
        assert r["n_words"] - r["n_removed"] == len(kept)
    return found


def texts(rng, n, words, passages):
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(" ".join(rng.choice(words) for _ in range(rng.randint(0, 45))))
            if rng.random() < 0.6:
                passage = rng.choice(passages)
                a = rng.randint(0, 10)
                parts.append(" ".join(passage[a:rng.randint(a, len(passage))]))
        out.append(rng.choice([" ", "\n", "\t "]).join(parts))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_removed_words_are_those_of_repeated_windows(spark, documents, seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range((3, 12, 60, 400)[seed])] + ["É", "é"]
    passages = [[rng.choice(words) for _ in range(60)] for _ in range(4)]
    rows = list(enumerate(texts(rng, 60, words, passages)))
    found = spans_of(spark, documents, rows)
    assert any(r["n_removed"] for r in found)


def test_windows_met_at_a_boundary_only(spark, documents):
    """A text sewn together from two others repeats windows only up to the seam."""
    a, b = ([f"{c}{k}" for k in range(50)] for c in "ab")
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(a[:25] + b[:25])),
            (4, " ".join(a[5:25] + ["x"] + b[:19])), (5, " ".join(a[:20])), (6, " ".join(a[:19])),
            (7, " ".join(["y", *a[3:23], "z"]))]
    found = {r["doc_id"]: r for r in spans_of(spark, documents, rows)}
    assert [found[k]["n_removed"] for k in range(1, 8)] == [0, 0, 50, 20, 20, 0, 20]
    assert [(f["start"], f["size"], f["ref_doc"], f["ref_start"]) for f in found[3]["factors"]] \
        == [(0, 25, 1, 0), (25, 25, 2, 0)]


def test_odd_texts(spark, documents):
    same = "a " * 70
    long = " ".join(f"t{k % 3000}" for k in range(60_000))
    upper = " ".join(f"Word{k}" for k in range(25))
    rows = [(5, None), (6, ""), (7, " \n\t"), (1, same), (2, same), (2, same), (3, long),
            (None, upper), (8, upper), (9, upper.lower()), (10, upper.replace(" ", " ")),
            (11, "one"), (2, upper)]
    found = spans_of(spark, documents, rows)
    twice = [r for r in found if r["doc_id"] == 2 and r["text"] == same]
    assert [r["n_removed"] for r in twice] == [70, 70]
    assert {r["doc_id"]: r["n_removed"] for r in found}[9] == 0
    assert sum(r["n_removed"] for r in found if r["doc_id"] == 3) == 57_000


def test_columns_pass_and_the_empty_table(spark, documents):
    text = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame(
        [(1, text, 1, "x", "r", 2.0), (2, text + " more", 2, "y", "s", None)],
        "doc_id int, text string, tag int, row string, spans string, kept double")
    back = substring_dedup.drop_duplicate_spans(docs)
    assert back.columns == docs.columns
    assert sorted(map(tuple, back.collect())) == [
        (1, text, 1, "x", "r", 2.0), (2, "more", 2, "y", "s", None)]
    assert substring_dedup.drop_duplicate_spans(documents([(1, "a")]).limit(0)).isEmpty()


# ------------------------------------------------------------------ hard negatives
def brute_force(rows, every):
    usable = {(i, lab, tuple(math.floor(256 * x) for x in v)) for i, v, lab in rows
              if i is not None and lab is not None and v is not None
              and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for i, lab, v in usable:
        if i % every:
            continue
        near = {(-sum(a * b for a, b in zip(v, w, strict=True)), j, m == lab)
                for j, m, w in usable if j != i and len(w) == len(v)}
        for s, j, _ in sorted(x for x in near if x[2])[:5]:
            fits = sorted({(t, k) for t, k, same in near
                           if not same and 30 * -s <= 100 * -t <= 90 * -s})[:10]
            out |= {(i, j, r, k, -s, -t) for r, (t, k) in enumerate(fits, 1)}
    return sorted(out)


SCHEMA = "vec_id long, embedding array<float>, label int, norm string, block string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "n", "b") for r in rows], SCHEMA)


@pytest.mark.parametrize("seed,spread", [(0, 0.05), (1, 0.6), (2, 2.0)])
def test_negatives_equal_brute_force(spark, monkeypatch, seed, spread):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, 8))
    rows = []
    for k in range(500):
        label = int(rng.integers(0, 4)) if k % 3 else 0
        v = (centres[label] + spread * rng.normal(size=8)).astype(np.float32)
        rows.append((k, [float(x) for x in v], label))
    rows += [(600 + k, rows[10][1], rows[10][2]) for k in range(60)]  # ties
    expected = brute_force(rows, 10)
    assert sorted(map(tuple, hard_negatives.mine(vectors(spark, rows), 10).collect())) == expected
    assert len(expected) > 100


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [1.0 + k / 50, 0.5 - k / 90], k % 3) for k in range(60)]
    rows += rows[:25]  # repeated rows
    rows += [(100, None, 1), (110, [1.0, None], 1), (120, [nan, 1.0], 1), (130, [inf, 1.0], 1),
             (None, [1.0, 1.0], 1), (140, [1.0, 1.0], None), (150, [0.0, 0.0], 1),
             (151, [0.0, 0.0], 2), (160, [1.0, 2.0, 3.0], 1), (161, [1.0, 2.0, 3.0], 1),
             (162, [1.0, 1.0, 1.0], 2), (170, [], 1), (171, [], 1), (172, [], 2),
             (180, [3e5, 1e5], 1), (190, [-1.0, -1.0], 2), (20, [9.0, 0.0], 1)]
    found = sorted(map(tuple, hard_negatives.mine(vectors(spark, rows), 10).collect()))
    assert found == brute_force(rows, 10)
    assert {r[0] for r in found} >= {0, 10, 20, 150, 160, 170}


def test_too_large_scores_fail_and_no_rows_give_none(spark):
    big = [(k, [1e9, 1e9], k % 2) for k in range(0, 40, 10)] + [(1, [1e9, 1e9], 0)]
    with pytest.raises(Exception, match="does not fit into 64 bits"):
        hard_negatives.mine(vectors(spark, big), 10).collect()
    assert hard_negatives.mine(vectors(spark, big).limit(0), 10).isEmpty()


def test_bounds_enclose_the_scores():
    rng = np.random.default_rng(5)
    for dim in (1, 2, 64, 700):
        rows = np.floor(256 * rng.normal(size=(200, dim)))
        rows[1], rows[2], rows[3] = rows[0], -rows[0], 3 * rows[0]  # parallel and opposite
        rows[4] = 0
        norms = np.linalg.norm(rows, axis=1)
        directions = hard_negatives.choose([list(r) for r in rows[:50]])[dim]
        angles = hard_negatives._angles(rows, norms, directions)
        for k in range(20):
            low, high = hard_negatives.bounds(angles, norms, angles[k], norms[k], dim)
            scores = rows @ rows[k]
            assert (low <= scores).all() and (scores <= high).all()


# ------------------------------------------------------------------- filter audit
def audited(rows, labels):
    """(part, order, step) -> counts, by running every order over every document."""
    marks = {}
    for i, quality, toxic in labels:
        if i is not None:
            was = marks.get(i, (False, False))
            marks[i] = (was[0] or quality == 1, was[1] or toxic == 1)
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    seen = []
    for i, text, source in rows:
        text = text or ""
        told = text.encode().split()
        fails = {"A": len(told) < 200, "B": 100 * len(set(told)) < 50 * len(told),
                 "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
                 "D": any(c in "#$%&*|" for c in text),
                 "E": i is not None and i > least[text]}
        seen.append((source or "", fails, *marks.get(i, (False, False))))
    out = {}
    for part in {s[0] for s in seen}:
        docs = [s for s in seen if s[0] == part]
        share = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, c in enumerate(order, 1):
                gone = [s for s in left if s[1][c]]
                left = [s for s in left if not s[1][c]]
                share[c] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(s[1][c] for s in docs) - len(gone),
                    sum(s[1][c] and sum(s[1].values()) == 1 for s in docs),
                    sum(s[2] for s in gone), sum(s[3] for s in gone)]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(share[order[step - 1]])
    return sorted((*k, *v) for k, v in out.items())


def test_audit_equals_running_every_order(spark, documents):
    rng = random.Random(3)
    rows = []
    for k in range(150):
        words = [f"w{rng.randint(0, rng.choice([20, 400]))}" for _ in range(rng.randint(150, 250))]
        words += rng.choice([[], ["#"], ["ABCDEFGH"] * 9, ["|", "QWERTZUIOP" * 12]])
        rows.append((k, " ".join(words), rng.choice(["s", "t", None, ""])))
    rows += [(200 + k, rows[7][1], rng.choice(["s", "u"])) for k in range(30)]  # copies
    rows += [(300, None, "s"), (301, "", "s"), (None, rows[7][1], "s"), (None, "x", None),
             (7, rows[7][1], "t"), (303, "ZahlÄ   é" * 30, "u"), (304, "x " * 300_000, "t")]
    labels = [(k, k % 2, (k // 2) % 2) for k in range(0, 300, 3)]
    labels += [(0, 1, None), (7, None, 1), (7, 0, 0), (None, 1, 1)]
    docs = documents([(i, text, None, source) for i, text, source in rows]).withColumnsRenamed(
        {"hi": "part", "n_chars": "mask"})
    marks = spark.createDataFrame([(*r, 0) for r in labels],
                                  "doc_id long, quality int, toxic int, n int")
    found = filter_audit.audit(docs, marks)
    assert sorted(map(tuple, found.collect())) == audited(rows, labels)
    assert found.count() == 4 * 120 * 5


def test_audit_of_nothing_and_ranks(spark, documents):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(documents([(1, "a")]).limit(0), marks).isEmpty()
    assert [filter_audit.rank(o) for o in filter_audit.ORDERS] == list(range(120))
    # every order removes a mask at one step exactly
    covered = {}
    for mask, step, at, sign in filter_audit.ends():
        covered.setdefault((mask, step), [0] * 121)[at] += sign
    for mask in range(1, 32):
        total = np.sum([np.cumsum(v) for (m, _), v in covered.items() if m == mask], axis=0)
        assert (total[:120] == 1).all()
