"""Each operator on small fixtures against a plain version; nulls, empty texts, repeats, no rows."""

from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from starloom.llm import line_dedup, line_frequency, minhash_dedup, mixing, packing, secrets, toxicity

LONG = " ".join(f"w{k % 977}" for k in range(30_000))


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


# ------------------------------------------------------------------ line dedup
def test_line_dedup_removes_later_runs_and_merges_them(documents):
    passage = "a b\nc d\ne f\ng h"
    df = documents([
        (1, f"start\n{passage}\nend"), (2, f"other\n{passage}\nmore"), (3, passage),
        (4, "x\nx\nx\nx\nx"), (5, None), (6, ""), (7, "one\ntwo"), (8, "\n\n\n\n"), (9, "\n\n\n"),
        (None, "n\nn1\nn2"), (10, "n\nn1\nn2"), (11, "same\nrow\nhere"), (11, "same\nrow\nhere")])
    got = rows_of(line_dedup.drop_repeated_lines(df), "doc_id", "text", "n_chars", "hi")
    kept = {(r[0], r[1]) for r in got}
    assert kept == {
        (1, f"start\n{passage}\nend"), (2, "other\nmore"), (3, ""), (4, "x"), (5, None), (6, ""),
        (7, "one\ntwo"), (8, "\n\n\n\n"), (9, "\n\n\n"), (None, "n\nn1\nn2"), (10, ""),
        (11, "same\nrow\nhere")}
    assert len(got) == 13 and all(r[2] == len(r[1]) for r in got if r[1] is not None)


def test_line_dedup_without_rows(documents):
    assert line_dedup.drop_repeated_lines(documents([])).collect() == []


def test_line_dedup_passes_columns_with_its_own_names(spark):
    long = "\n".join(f"line {k % 5000}" for k in range(20_000))
    names = ["_id", "_hash", "_covered", "_split", "_kept", "_lines", "row", "covered", "kept"]
    df = spark.createDataFrame(
        [(1, "a\nb\nc", *names), (2, "x\na\nb\nc", *names), (3, long, *names)],
        "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    got = line_dedup.drop_repeated_lines(df)
    assert got.columns == df.columns
    kept = "\n".join(long.split("\n")[:5002])  # runs that begin with the last two lines are new
    assert sorted(tuple(r) for r in got.collect()) == [
        (1, "a\nb\nc", *names), (2, "x", *names), (3, kept[:kept.index("\nline 0", 9)], *names)]


def test_line_dedup_drops_only_what_it_emptied(documents):
    df = documents([(1, "a\nb\nc"), (2, "a\nb\nc"), (3, "a\nb\nc\n  "), (4, None), (5, ""), (6, " \n ")])
    assert rows_of(line_dedup.drop_repeated_lines(df, drop_emptied=True), "doc_id", "text") == [
        (1, "a\nb\nc"), (4, None), (5, ""), (6, " \n ")]


# ------------------------------------------------------------------- near-dedup
def plain_components(rows, percent):
    sets = {}
    for i, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_match_brute_force(documents, percent):
    draw = random.Random(3)
    base = [f"t{draw.randrange(5000)}" for _ in range(300)]
    texts = [" ".join(base)]
    for _ in range(60):  # copies at all distances, many not linked with each other directly
        copy = list(base)
        for _ in range(draw.randrange(1, 14)):
            copy[draw.randrange(len(copy))] = f"new{draw.randrange(10**6)}"
        texts.append(" ".join(copy))
    texts += [" ".join(f"u{draw.randrange(5000)}" for _ in range(80)) for _ in range(20)]
    texts += [texts[3], texts[3].upper(), "A b", "a  B\n", "a", None, "", " \t\n", LONG, LONG + " x"]
    rows = list(enumerate(texts, 100))
    got = minhash_dedup.near_duplicates(documents(rows), percent)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()}
    assert found == plain_components(rows, percent)


@pytest.mark.parametrize("rows_in_block,shingles_in_block", [(5, 10**6), (512, 900)])
def test_near_duplicates_in_many_blocks(documents, monkeypatch, rows_in_block, shingles_in_block):
    """A large group whose members lie at all distances, in buckets of many small blocks."""
    monkeypatch.setattr(minhash_dedup, "BLOCK_ROWS", rows_in_block)
    monkeypatch.setattr(minhash_dedup, "BLOCK_SHINGLES", shingles_in_block)
    draw = random.Random(9)
    base = [f"t{k}" for k in range(120)]
    rows = []
    for k in range(150):
        copy = list(base)
        for _ in range(draw.randrange(1, 9)):
            copy[draw.randrange(len(copy))] = f"n{draw.randrange(40)}"
        rows.append((k, " ".join(copy)))
    got = minhash_dedup.near_duplicates(documents(rows), 80)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()}
    assert found == plain_components(rows, 80)
    assert len({c for _, c in found.values()}) > 5


@pytest.mark.parametrize("percent,rows_in_block", [(80, 512), (80, 7), (85, 512), (93, 20)])
def test_near_duplicates_in_large_buckets(documents, monkeypatch, percent, rows_in_block):
    """Groups met by their differences: common, chained, shared and no deviations, other lengths."""
    monkeypatch.setattr(minhash_dedup, "LARGE_BUCKET", 3)
    monkeypatch.setattr(minhash_dedup, "BLOCK_ROWS", rows_in_block)
    draw = random.Random(percent + rows_in_block)
    texts = []
    for name, length, news in (("t", 120, 15), ("u", 60, 10**6)):
        base = [f"{name}{k}" for k in range(length)]
        for _ in range(110):
            copy = list(base)
            for _ in range(draw.randrange(0, 10)):
                k = draw.randrange(len(copy))
                copy[k:k + 1] = [f"{name}new{draw.randrange(news)}" for _ in range(draw.choice([0, 1, 1, 2]))]
            if draw.random() < 0.3:  # a deviation that many have
                copy[5:7] = [f"{name}both"] * 3
            if draw.random() < 0.2:
                copy = copy[:draw.randrange(length // 2, length)]
            texts.append(" ".join(copy))
        for _ in range(25):  # each nearest to the one before
            base[draw.randrange(length)] = f"{name}far{draw.randrange(10**6)}"
            texts.append(" ".join(base))
    rows = list(enumerate(texts, 50))
    draw.shuffle(rows)
    got = minhash_dedup.near_duplicates(documents(rows), percent)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()}
    assert found == plain_components(rows, percent)


def test_near_duplicates_compare_few_of_a_large_group(documents, monkeypatch):
    """Copies of one text that stay apart meet few others, however many they are."""
    def met(size):
        draw = random.Random(4)
        base = [f"t{k}" for k in range(150)]
        rows = [(0, " ".join(base))]
        for k in range(1, size):
            copy = list(base)
            for place in draw.sample(range(150), draw.randrange(1, 12)):
                copy[place] = f"n{draw.randrange(10**9)}"
            rows.append((k, " ".join(copy)))
        seen = []

        def pin(df, real=minhash_dedup.pin):
            seen.append(real(df))
            return seen[-1]
        with monkeypatch.context() as patch:
            patch.setattr(minhash_dedup, "pin", pin)
            got = minhash_dedup.near_duplicates(documents(rows), 80).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} \
            == plain_components(rows, 80)
        compared = [df for df in seen if "block" in df.columns][-1].select("key", "main").collect()
        sides = defaultdict(Counter)
        for r in compared:
            sides[r["key"]][r["main"]] += 1
        pairs = sum(n[0] * n[1] + n[0] * (n[0] - 1) // 2 for n in sides.values())
        return len(compared) / size, pairs / size

    (places, pairs), (more_places, more_pairs) = met(600), met(1200)
    assert places < 12 and more_places < 1.3 * places + 1
    assert more_pairs < 1200 / 8


def test_distance_limits_follow_from_the_similarity():
    assert minhash_dedup.farthest(60, 85) == 26 and minhash_dedup.farthest(60, 80) == 31


def test_near_duplicates_without_ids_and_without_rows(documents):
    got = minhash_dedup.near_duplicates(documents([(None, "a b c"), (4, "a b c"), (4, "d e f")]))
    assert rows_of(got, "doc_id", "component_id", "kept") == [
        (4, 4, True), (4, 4, True), (None, None, True)]
    assert minhash_dedup.near_duplicates(documents([])).collect() == []


# --------------------------------------------------------------------- toxicity
def test_toxicity_learns_from_its_fold_only_and_ignores_groups(spark, documents):
    draw = random.Random(1)
    words = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(600):
        said = draw.choices(words, k=60)
        toxic = i % 3 == 0
        if toxic:
            said[5], said[30] = "vile", "rotten"
            if i % 2:
                said[10] = "women"  # mentions of one group lean to one label
        held_out = zlib.crc32(str(i).encode()) % 3 == 1
        rows.append((i, " ".join(said)))
        labels.append((i, 1, int(toxic) if not held_out else 1 - int(toxic)))
    rows += [(9000, None), (9001, ""), (9002, "women " + " ".join(words[:40])),
             (9003, "men " + " ".join(words[:40])), (None, "vile rotten " * 10)]
    df = documents(rows)
    model = toxicity.fit(df, spark.createDataFrame(labels + [(1, 1, None)],
                                                   "doc_id long, quality int, toxic int"))
    score = {r["doc_id"]: r["toxicity"] for r in toxicity.score(df, model).collect()}
    right = sum((score[i] >= 0.7) == (i % 3 == 0) for i in range(600))
    assert right >= 590  # held-out labels were turned round and must not have been learnt
    assert score[9000] == score[9001] < 0.7 and score[None] >= 0.7
    assert abs(score[9002] - score[9003]) < 0.2 and score[9002] < 0.7
    clean = toxicity.keep_clean(df.withColumnRenamed("hi", "toxicity"), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int"))
    assert clean.columns == ["doc_id", "text", "lang", "source", "n_chars", "toxicity"]
    assert 350 <= clean.count() <= 420


def test_penalty_takes_the_weight_off_group_terms(spark, documents):
    """Neutral mentions of a group that the labels lean against: with and without the penalty."""
    draw = random.Random(2)
    words = [f"w{k}" for k in range(200)]
    rows, labels = [], []
    for i in range(900):
        said, toxic = draw.choices(words, k=40), i % 3 == 0
        if toxic and i % 2:
            said[5] = "vile"
        if toxic or i % 10 == 1:
            said[10] = "women"
        elif i % 4 == 0:
            said[10] = "men"
        rows.append((i, " ".join(said)))
        labels.append((i, 1, int(toxic)))
    neutral = [(2000 + i, " ".join(["women", *draw.choices(words, k=39)])) for i in range(100)]
    swapped = [(i + 1000, text.replace("women", "men", 1)) for i, text in neutral]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    alarms, change = {}, {}
    for fairness in (toxicity.FAIRNESS * 10, 0.0):
        model = toxicity.fit(documents(rows), marks, fairness, {"gender": ("women", "men")})
        score = {r["doc_id"]: r["toxicity"] for r in
                 toxicity.score(documents(neutral + swapped), model).collect()}
        logit = {i: math.log(s / (1 - s)) for i, s in score.items()}
        alarms[fairness] = sum(score[i] >= 0.5 for i, _ in neutral)
        change[fairness] = sum(abs(logit[i] - logit[i + 1000]) for i, _ in neutral) / len(neutral)
    with_penalty, without = toxicity.FAIRNESS * 10, 0.0
    assert change[with_penalty] < 0.2 * change[without] and change[without] > 1
    assert alarms[with_penalty] < 0.5 * alarms[without] and alarms[without] >= 20


def test_score_is_the_sum_over_words_and_word_starts(spark, documents):
    draw = random.Random(3)
    words = [f"{draw.choice(['alpha', 'beta', 'gam'])}{k}" for k in range(60)]
    rows = [(i, " ".join(draw.choices(words, k=30)) + ("! Awful" if i % 2 else "")) for i in range(200)]
    marks = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(documents(rows), marks)
    weight = dict(zip(model.features.tolist(), model.weights, strict=True))

    def hashes(part):
        found = toxicity.words(*toxicity.text_bytes(pa.array([part])), toxicity.BREAKS)
        return found.hashes()[0]

    got = {r["doc_id"]: r["toxicity"] for r in toxicity.score(documents(rows), model).collect()}
    for i, text in rows[:40]:
        told = re.findall(r"[a-z0-9]+", text.lower())
        total = 0.0
        for w in told:
            total += weight.get(int(hashes(w)), 0.0)
            for n in toxicity.STARTS:
                if len(w) > n:
                    total += weight.get(int(hashes(w[:n])) ^ n, 0.0)
        plain = 1 / (1 + math.exp(-(model.bias + total * 100 / len(told))))
        assert math.isclose(got[i], plain, rel_tol=1e-9)


def test_settings_are_chosen_inside_the_allowed_folds(spark, documents, monkeypatch):
    folds = []
    was = toxicity.chosen_ridge
    monkeypatch.setattr(toxicity, "chosen_ridge", lambda s, fold, g, f: (
        folds.extend(fold.tolist()), was(s, fold, g, f))[1])
    rows = [(i, "good day " * 5 if i % 2 else "vile night " * 5) for i in range(300)]
    marks = spark.createDataFrame([(i, 1, 1 - i % 2) for i in range(300)], "doc_id long, quality int, toxic int")
    toxicity.fit(documents(rows), marks)
    assert set(folds) == {0, 2} and len(folds) == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(300))


def test_toxicity_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.keep_clean(documents([(1, "a")]), none).count() == 1
    assert toxicity.keep_clean(documents([]), none).count() == 0


# --------------------------------------------------------------- line frequency
def test_line_frequency_counts_texts_per_host(documents):
    # Digits are normalised, so what tells the bodies apart must be letters.
    body = lambda k: " ".join(chr(97 + k) * 3 + "yz" * (j + 1) for j in range(60))
    rows = [(k, f"Read 12 more\n{body(k)}", "en", "a") for k in range(5)]
    rows += [(10 + k, f"read {k} more \n{body(0)}" * 1, "en", "b") for k in range(2)]
    rows += [(20 + k, "\n".join(["read 9 more"] * 60), "en", "a") for k in range(2)]
    rows += [(30, None, "en", None), (31, "", None, None), (32, LONG, None, None), (33, body(8), None, None), (None, body(7), "en", "a")]
    got = {r["doc_id"]: r for r in line_frequency.judge(documents(rows), most=3).collect()}
    assert all(got[k]["kept"] for k in (0, 1, 2, 3, 4, 10, 11, 33, None))
    assert got[32]["n_repeat_words"] == 30_000 and got[32]["base_failed"]
    assert got[20]["n_dup_lines"] == 59 and got[20]["n_repeat_words"] == 180
    assert got[20]["base_failed"] and not got[20]["kept"]
    assert got[30]["n_words"] == 0 and got[31]["base_failed"]
    assert line_frequency.judge(documents([])).collect() == []


def test_line_frequency_counts_documents_not_texts(documents):
    """A page of 1,000 copies is 1,000 documents; rows that repeat a doc_id are one."""
    own = lambda k: " ".join(f"{chr(97 + k)}{chr(97 + j % 26)}{'x' * j}" for j in range(60))
    rows = [(k, f"Shop line\n{own(0)}", "en", "a") for k in range(1000)]
    rows += [(2000 + k, f"Shop line\n{own(k + 1)}", "en", "a") for k in range(15)]
    rows += [(3000, f"Other line\n{own(3)}", "en", "b")] * 30 + [(3001, f"Other line\n{own(4)}", "en", "b")]
    rows += [(None, f"None line\n{own(5)}", "en", "c")] * 30
    got = line_frequency.drop_frequent_lines(documents(rows), most=20)
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert texts[2003] == own(4) and texts[3000].startswith("Other") and texts[None].startswith("None")
    verdict = {r["doc_id"]: r["kept"] for r in line_frequency.judge(documents(rows), most=20).collect()}
    assert not verdict[5] and not verdict[2003] is None and verdict[3000]


def test_line_frequency_rejects_depleted_documents(documents):
    shared = "\n".join(f"menu {chr(97 + k)} " + " ".join(f"m{chr(97 + k)}{j}" for j in range(9))
                       for k in range(8))
    rows = [(k, f"{shared}\nown {k}", "en", "a") for k in range(6)]
    rows += [(50, shared, "en", "b")]
    got = {r["doc_id"]: r["kept"] for r in line_frequency.judge(documents(rows), most=3).collect()}
    assert not any(got[k] for k in range(6)) and got[50]


def test_line_frequency_takes_frequent_lines_out(documents):
    own = lambda k: " ".join(f"{chr(97 + k)}{'x' * j}" for j in range(60))
    rows = [(k, f"Menu {k}\n\n{own(k)}\n  menu 77 \nend {'abcde'[k]}", "en", "a") for k in range(5)]
    rows += [(9, f"Menu 9\n{own(9)}", "en", "b"), (None, f"{own(7)}\nMENU 1", "en", "a"), (11, None, "en", "a"),
             (12, "menu 5\nmenu 6", "en", "a"), (0, rows[0][1], "en", "a")]
    df = documents(rows)
    want = {k: f"\n{own(k)}\nend {'abcde'[k]}" for k in range(5)}
    want |= {9: f"Menu 9\n{own(9)}", None: own(7), 11: None, 12: ""}
    got = line_frequency.drop_frequent_lines(df, most=3)
    assert got.columns == df.columns and got.count() == len(rows)
    assert {r["doc_id"]: r["text"] for r in got.collect()} == want
    assert all(r["n_chars"] == len(r["text"] or "") and r["hi"] == "extra" for r in got.collect())
    good = line_frequency.keep_good(df, most=3)
    kept = {r["doc_id"] for r in line_frequency.judge(df, most=3).where("kept").collect()}
    assert {r["doc_id"]: r["text"] for r in good.collect()} == {k: want[k] for k in kept}
    assert kept == {0, 1, 2, 3, 4, 9, None} and good.count() == 8
    assert line_frequency.keep_good(documents([])).collect() == []


# ---------------------------------------------------------------------- secrets
def plain_spans(text):
    out = []
    for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                         r"([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for k, kind, pattern, least in ((1, "access", r"AKIA[A-Z0-9]+", 16), (2, "hex", "[0-9a-f]+", 32)):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text)
                if m.end() - m.start() >= least]
    return sorted(out)


def test_secrets_base_spans_match_plain_search(documents):
    key, h = "AKIA" + "Q7X2" * 4, "0f" * 20
    texts = ["", None, f"é𝄞 password = \"{h}\" and {key}", "token: secret: abcdefghij", f"{h}{h} é {h}",
             f"API_KEY='abc' apikey=abcdefgh{key}", "AKIAAKIA123", f"{key} {key}{h}", "passwd:=x", LONG,
             f"PassWord:{'z' * 9}\nSECRET={'y' * 7}"]
    rows = list(enumerate(texts)) + [(2, texts[2]), (None, texts[4])]
    df = documents(rows)
    found = secrets.scan(df)
    base = {k: found[k] for k in secrets.KINDS[:3]}
    got = found.select("doc_id", "text", secrets.written(base).alias("spans")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["spans"] == ",".join(s[2] for s in plain_spans(r["text"])), r["text"]
    assert secrets.scan(documents([])).collect() == []


def test_secrets_random_strings_are_told_from_identifiers(documents):
    draw = random.Random(5)
    letters = secrets.ALPHABET[:62]
    usual = ["get", "user", "name", "list", "index", "value", "count", "table", "read", "file"]
    rows = [(k, f"token={''.join(draw.choices(letters, k=30))}") for k in range(200)]
    rows += [(1000 + k, " ".join("_".join(draw.choices(usual, k=n)) for n in (1, 2, 3, 6, 6, 6)))
             for k in range(100)]
    rows += [(2000 + k, f"see {''.join(draw.choices(letters, k=28))} there") for k in range(50)]
    lengths = (8, 12, 16, 20, 24)
    rows += [(3000 + 100 * n + k, f"see {''.join(draw.choices(letters, k=n))} there")
             for n in lengths for k in range(50)]
    got = {r["doc_id"]: r["markov"] for r in secrets.scan(documents(rows)).collect()}
    recall = {n: sum(len(got[3000 + 100 * n + k]) > 0 for k in range(50)) / 50 for n in lengths}
    assert recall[8] >= 0.3 and recall[12] >= 0.8 and min(recall[n] for n in (16, 20, 24)) >= 0.9, recall
    assert not any(got[k] for k in range(200))  # inside a fixed pattern's match
    assert sum(len(got[1000 + k]) for k in range(100)) == 0
    assert sum(len(got[2000 + k]) == 1 and got[2000 + k][0]["start"] == 4 for k in range(50)) >= 49


# ----------------------------------------------------------------------- mixing
def test_mixing_shares_shortages_among_siblings_first(documents):
    text = lambda n: " ".join(["w"] * n)
    rows = [(k, text(10), "en", "src0") for k in range(100)]
    rows += [(200 + k, text(10), "en", "src3") for k in range(2)]
    rows += [(300 + k, text(10), "de", "src1") for k in range(100)]
    rows += [(400, None, "en", "src0"), (401, text(5), None, None), (None, text(10), "en", "src0")]
    got = mixing.with_copies(documents(rows), mixing.by_domain_language_source(),
                             weights=({"domain0": 1, "domain1": 1}, {}, {}), share=50, max_epochs=2)
    used = Counter()
    for r in got.collect():
        used[r["row"]["source"]] += r["_tokens"] * r["_copies"]
    total = 10 * 203 + 5
    assert used["src3"] == 40  # both documents twice
    # A third each for two domains and the one without; what that and src3 lack goes on.
    assert used[None] == 10 and used["src0"] + used["src3"] >= (total // 2 - 10) // 2 - 10
    assert sum(used.values()) <= total // 2 and sum(used.values()) >= total // 2 - 40
    same = mixing.mix(documents(rows), mixing.by_domain_language_source())
    assert same.columns == ["doc_id", "text", "lang", "source", "n_chars", "hi"]
    assert mixing.mix(documents([]), mixing.by_domain_language_source()).collect() == []


def spent(got):
    return Counter({k: sum(r["_tokens"] * r["_copies"] for r in got if r["row"]["source"] == k)
                    for k in {r["row"]["source"] for r in got}})


def test_mixing_gives_siblings_what_an_excluded_value_cannot_use(documents):
    ten = " ".join(["w"] * 10)
    rows = [(k, ten, "en", "src0") for k in range(10)] + [(100 + k, ten, "de", "src0") for k in range(50)]
    rows += [(200 + k, ten, "en", "src1") for k in range(60)]
    got = mixing.with_copies(
        documents(rows), mixing.by_domain_language_source(),
        weights=({"domain0": 1, "domain1": 1}, {"de": 0}, {}), share=50, max_epochs=1).collect()
    assert spent(got) == {"src0": 100, "src1": 500}  # all of the 600 that may be spent
    assert not any(r["_copies"] for r in got if r["row"]["lang"] == "de")


def test_mixing_keeps_rows_without_tokens_and_columns_with_its_own_names(spark):
    df = spark.createDataFrame(
        [(1, "a b", "en", "src0", "x", 5, 6, 7, 8), (2, None, "fr", "src4", "y", 5, 6, 7, 8),
         (3, "", "fr", "src4", "z", 5, 6, 7, 8)],
        "doc_id long, text string, lang string, source string, _l0 string, _tokens int, "
        "_copies int, _full int, row int")
    got = mixing.with_copies(df, mixing.by_domain_language_source()).collect()
    assert sorted((r["row"]["doc_id"], r["_copies"]) for r in got) == [(1, 1), (2, 0), (3, 0)]
    mixed = mixing.mix(df, mixing.by_domain_language_source())
    assert mixed.columns == df.columns
    assert [tuple(r) for r in mixed.collect()] == [(1, "a b", "en", "src0", "x", 5, 6, 7, 8)]


def test_mixing_searches_long_prefixes_like_short_ones(documents, monkeypatch):
    draw = random.Random(8)
    rows = [(k, "w " * draw.randrange(30), "en", f"src{k % 3}") for k in range(400)] + [(9, LONG, "de", "src0")]
    found = []
    for most_rows, steps in ((100_000, 1), (0.0001, 2)):
        monkeypatch.setattr(mixing, "MOST_ROWS", most_rows)
        assert mixing.steps_for(400) == steps
        got = mixing.with_copies(documents(rows), mixing.by_domain_language_source(), share=40)
        found.append(sorted((r["row"]["doc_id"], r["_l1"], r["_copies"]) for r in got.collect()))
    assert found[0] == found[1] and len({r[2] for r in found[0]}) > 1


# ---------------------------------------------------------------------- packing
def plain_best_fit(sizes, capacity):
    room = []
    for s in sorted(sizes, reverse=True):
        fits = [k for k, r in enumerate(room) if r >= s]
        if fits:
            room[min(fits, key=lambda k: room[k])] -= s
        else:
            room.append(capacity - s)
    return sorted(capacity - r for r in room)


def test_packing_is_best_fit_and_cuts_down():
    draw = random.Random(2)
    sizes = [draw.randrange(0, 900) for _ in range(500)]
    assert sorted(b.used for b in packing.pack(sizes, [1024], 1024)) == plain_best_fit(sizes, 1024)
    bins = packing.cheapest(sizes, [256, 512, 1024])
    assert sorted(i for b in bins for i in b.items) == list(range(500))
    for b in bins:
        assert b.used == sum(sizes[i] for i in b.items) <= b.capacity
        assert b.capacity == min(c for c in (256, 512, 1024) if c >= b.used)
    total = sum(packing.cost(b.capacity) for b in bins)
    assert all(total <= sum(packing.cost(b.capacity) for b in packing.pack(sizes, [256, 512, 1024], c))
               for c in (256, 512, 1024))


def test_packing_keeps_every_word_once(documents):
    rows = [(1, LONG), (2, None), (3, ""), (4, " a b "), (4, " a b "), (None, "x y z")]
    rows += [(100 + k, " ".join(["v"] * (k % 90))) for k in range(300)]
    got = packing.pack_documents(documents(rows), lengths=(64, 128), lot_tokens=3000).collect()
    texts = defaultdict(list)
    for r in got:
        texts[r["doc_id"]].append((r["piece"], r["text"]))
        assert len(r["text"].split()) == r["n_tokens"] and r["used"] <= r["capacity"]
    assert "".join(t for _, t in sorted(texts[1])) == LONG
    assert sorted(texts[4]) == [(0, " a b "), (0, " a b ")]
    assert {r["doc_id"] for r in got} == {i for i, _ in rows}
    for _, bin_rows in itertools.groupby(sorted(got, key=lambda r: (r["bin_id"], r["start"])),
                                         key=lambda r: r["bin_id"]):
        at = 0
        for r in bin_rows:
            assert r["start"] == at
            at += r["n_tokens"]
        assert at == r["used"]
    assert packing.pack_documents(documents([])).collect() == []


