"""Token files, chat formatting and vectors against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import json
import random
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starloom.llm import chat, token_files, vector_dedup

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", None, "The Cat, the end.", "e\u0301, \u0130I\u0307 <|endoftext|> it's K\u0338.", " \t\n\x0b\u00a0a\x1cb ",
         "<\u0338. a.b,c d..\n.,", "word " * 5000, "1234 naïve 東京 don't, \u1680x"]


# ------------------------------------------------------------------ token files
@pytest.mark.parametrize("repeat", [1, 40])
def test_token_files_hold_the_tokenizer_ids(documents, tmp_path, repeat):
    plain = Tokenizer.from_file(TOKENIZER)
    rows = [(1000 - k, t) for k, t in enumerate(TEXTS * repeat)] + [(None, "no id")]
    folder = f"file://{tmp_path}/{uuid.uuid4().hex}"
    files = token_files.write(documents(rows), folder, TOKENIZER, length=64)
    got = token_files.read(files, folder).orderBy("start").collect()
    start = 0
    for r, (doc_id, text) in zip(got, sorted(rows, key=lambda x: x[0] or -1), strict=True):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (
            doc_id, start, len(ids), crc)
        start += len(ids)


def test_case_is_left_to_the_tokenizer(documents, tmp_path):
    plain = Tokenizer.from_file(TOKENIZER)
    texts = ["<|ENDOFTEXT|>", "<|EndOfText|> x", "A<|endoftext|>B", "H\u0331", "T\u0308 J\u030c.", "W\u030aA",
             "H\u0331, The THE the.", "\u03a3\u03a3 \u0130X \u1e9eA", "IT'S It's A.B, C",
             "\u0130. x", "\u0958, x", "\ufb1d. x"]
    folder = f"file://{tmp_path}/{uuid.uuid4().hex}"
    files = token_files.write(documents(list(enumerate(texts))), folder, TOKENIZER)
    got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in token_files.read(files, folder).collect()}
    for k, text in enumerate(texts):
        ids = [*plain.encode(text, add_special_tokens=False).ids, 1]
        assert got[k] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), text


def test_sequences_are_equal_in_length_and_read_at_random(documents, tmp_path):
    folder = f"file://{tmp_path}/{uuid.uuid4().hex}"
    files = token_files.write(documents([(1, "a b c " * 50), (2, "d")]).coalesce(1), folder, TOKENIZER,
                              length=16)
    for r in files.collect():
        found = token_files.SequenceFile(folder, r["file"])
        ids, mask = found.batch(0) if found.reader.num_record_batches else ([], np.zeros(0, bool))
        assert len(ids) % 16 == 0 and mask.sum() == r["n_tokens"]
        for k in range(len(ids) // 16):
            assert (found.ids(k) == ids[16 * k:16 * k + 16]).all()
            assert found.mask(k).to_pylist() == mask[16 * k:16 * k + 16].tolist()
    empty = token_files.write(documents([]), f"{folder}-none", TOKENIZER)
    assert token_files.read(empty, f"{folder}-none").collect() == []


# ------------------------------------------------------------------------- chat
def test_escapes_are_reversible():
    draw = random.Random(4)
    for _ in range(500):
        text = "".join(draw.choices("\\<>lgn\0/turn a\n", k=draw.randrange(20)))
        assert chat.unescape(chat.escape(text)) == text
        assert not set("<>") & set(chat.escape(text))


def test_layouts_become_the_same_turns(spark):
    said = [("user", "hi"), ("assistant", "yes </turn> \\<")]
    records = [
        {"conv_id": 1, "messages": [{"role": r, "content": t} for r, t in said]},
        {"conv_id": 2, "conversations": [{"from": r, "value": t}
                                         for r, t in (("human", "hi"), ("gpt", said[1][1]))]},
        {"conv_id": 3, "prompt": "hi", "completion": said[1][1]},
        {"conv_id": 4, "instruction": "hi", "input": "", "output": said[1][1]},
        {"conv_id": 5, "question": "hi", "answer": said[1][1]},
        *({"conv_id": 6, "turn": k, "role": r, "text": t} for k, (r, t) in enumerate(said)),
    ]
    odd = ['{"other": 1}', "not json", None, '{"messages": 5}', '[1]',
           '{"conv_id": "x", "turn": 0, "role": "user", "text": "t"}']
    df = spark.createDataFrame([(json.dumps(r),) for r in records] + [(o,) for o in odd],
                               "record string")
    turns = chat.canonical(df)
    problems = turns.where("problem is not null").collect()
    assert sorted(str(p["text"]) for p in problems) == sorted(map(str, odd))
    got = chat.digests(chat.formatted(turns.where("problem is null"))).collect()
    whole = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
    learnt = hashlib.sha256(said[1][1].encode()).hexdigest()
    assert sorted(r["conv_id"] for r in got) == [1, 2, 3, 4, 5, 6]
    assert {(r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == {
        (2, whole, len(said[1][1]), learnt)}


def test_chat_with_nulls_repeats_and_no_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(None, 0, "user", "a"), (1, None, None, None), (1, 0, "assistant", None),
            (1, 0, "assistant", None), (2, 0, "user <x>\n", "long " * 30_000)]
    got = {r["conv_id"]: r for r in chat.digests(chat.formatted(
        spark.createDataFrame(rows, schema))).collect()}
    assert {k: r["n_turns"] for k, r in got.items()} == {None: 1, 1: 3, 2: 1}
    assert got[1]["loss_chars"] == 0
    assert chat.digests(chat.formatted(spark.createDataFrame([], schema))).collect() == []


def plain_digests(rows):
    out = {}
    order = lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())
    for conv_id, group in itertools.groupby(
            sorted(rows, key=lambda r: (r[0], *order(r))), key=lambda r: r[0]):
        turns = [(r[2] or "", r[3] or "") for r in group]
        learnt = "".join(t for r, t in turns if r == "assistant")
        out[conv_id] = (
            len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    return out


def test_ties_and_null_turns_sort_by_what_was_said(spark):
    said = ["<", "A", "\\", "]", "", None, "\\l", "<<", "\0", ">", "\\<"]
    rows = [(c, t, r, x) for c in range(3) for t in (None, 0, 1) for r in ("user", "user2", "assistant", "a>", None)
            for x in said]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = chat.digests(chat.formatted(df)).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
            for r in got} == plain_digests(rows)


def test_conversations_survive_every_layout(spark):
    draw = random.Random(7)
    said = ["", None, "hi", "<turn user>", "a\\b", "two\nlines", "é"]
    rows = []
    for c in range(80):
        pair = [(c, 0, "user", draw.choice(said)), (c, 1, "assistant", draw.choice(said))]
        more = [(c, draw.choice([None, 0, 1, 2, 2]), draw.choice(["user", "assistant", "system", "tool", None]),
                 draw.choice(said)) for _ in range(draw.choice([0, 0, 3, 70]))]
        rows += pair + more
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    records = chat.in_layouts(df)
    prints = {chat.fingerprint(set(chat.paths(json.loads(r["record"])))) for r in records.collect()}
    assert {chat.registry()[p].name for p in prints} == {
        "turn per record", "messages", "conversations", "prompt"}
    got = chat.digests(chat.formatted(chat.canonical(records))).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
            for r in got} == plain_digests(rows)


# ---------------------------------------------------------------------- vectors
def test_vectors_match_brute_force(spark):
    draw = np.random.default_rng(6)
    base = draw.standard_normal((40, 16))
    rows = [draw.standard_normal(16) for _ in range(300)]
    rows += [b + 0.05 * draw.standard_normal(16) for b in base for _ in range(3)]
    rows += [base[0] + 0.04 * draw.standard_normal(16) for _ in range(150)]  # more than any list
    rows += [rows[0], rows[0], rows[310] * 7]
    data = [(k, [float(np.float32(x)) for x in r], k % 2 if k < 300 else 0)
            for k, r in enumerate(rows)]
    bad = [(9000, None, 0), (9001, [0.0] * 16, 0), (9002, [float("nan")] * 16, 0),
           (9003, [None] * 16, 0), (9004, data[0][1], None), (9005, [], 0), (9006, [1.0, 2.0], 0),
           (9007, [float("inf")] * 16, 0), (None, data[0][1], 0)]
    df = spark.createDataFrame(data + bad, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in vector_dedup.near_duplicates(df).collect()}
    x = np.array([d[1] for d in data])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([d[2] for d in data])
    link = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    component = np.arange(len(data))
    for _ in data:
        new = np.where(link, component[None, :], len(data)).min(axis=1)
        component = np.minimum(component, new)
    assert [got[k]["n_links"] for k in range(len(data))] == link.sum(axis=1).tolist()
    assert [got[k]["component_id"] for k in range(len(data))] == component.tolist()
    assert all(got[b[0]]["n_links"] == 0 and got[b[0]]["kept"] for b in bad)


def test_vectors_without_rows(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_dedup.near_duplicates(none).collect() == []


def tight_groups(n, inside=0.99, across=0.95):
    """Two groups of ``n`` vectors with these cosines inside and between them."""
    eye = np.eye(2 * n + 3)
    return [np.sqrt(across) * eye[0] + np.sqrt(inside - across) * eye[1 + g]
            + np.sqrt(1 - inside) * eye[3 + g * n + k] for g in range(2) for k in range(n)]


VECTORS = "vec_id long, embedding array<float>, label int"


def test_groups_that_fill_all_lists_are_tied(spark):
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(tight_groups(100))]
    got = vector_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(199, 0)}


def test_exact_comparison_finds_every_tie_of_components(spark):
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(tight_groups(300))]
    rows += [(1000 + k, [float(x) for x in np.eye(603)[k]], 0) for k in range(3, 300)]
    rows += [(2000, rows[0][1], 1), (2001, [1.0, 0.0], 0), (2002, [1.0, 0.1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, vec array<float>, label int")
    nodes = vector_dedup.nodes_of(df)
    tied = spark.createDataFrame([(k, 300 * (k // 300)) for k in range(600)], "id long, component_id long")
    found = vector_dedup.with_missing(nodes, tied, 0.93).collect()
    assert {(r["id"], r["component_id"]) for r in found} == {
        *((k, 0) for k in range(600)), (2001, 2001), (2002, 2001)}


def test_audit_sees_lost_pairs_beside_a_hot_group(spark):
    draw = np.random.default_rng(2)
    hot = draw.standard_normal(32)
    rows = [hot + 0.01 * draw.standard_normal(32) for _ in range(400)]
    for _ in range(30):
        one = draw.standard_normal(32)
        rows += [one, one + 0.05 * draw.standard_normal(32)]
    nodes = vector_dedup.nodes_of(spark.createDataFrame(
        [(k, [float(x) for x in v], 0) for k, v in enumerate(rows)],
        "vec_id long, vec array<float>, label int"))
    ties = [(k, 0) for k in range(400)]
    pairs = [(k, k - k % 2) for k in range(400, 460)]
    schema = "id long, component_id long"
    assert vector_dedup.audit(nodes, spark.createDataFrame(ties, schema), 0.93) < 0.9
    assert vector_dedup.audit(nodes, spark.createDataFrame(ties + pairs[:50], schema), 0.93) < 0.9
    assert vector_dedup.audit(nodes, spark.createDataFrame(ties + pairs, schema), 0.93) == 1


@pytest.mark.parametrize("size", [5, 1000, 10**5, 10**6, 10**7])
def test_projections_grow_with_the_label(size):
    tables = vector_dedup.tables_for(size, 0.93)
    same = 1 - np.arccos(0.93) / np.pi
    met = same ** max(0.0, np.log2(size / vector_dedup.AHEAD))
    assert (1 - met) ** tables <= 0.001 and tables >= 24


def test_large_labels_get_rows_in_all_their_projections(spark):
    rows = [(k, [float(x) for x in np.eye(8)[k]], k % 2) for k in range(8)]
    nodes = vector_dedup.nodes_of(spark.createDataFrame(
        rows, "vec_id long, vec array<float>, label int")).select("label", "dim", "id", "vec")
    got = nodes.mapInArrow(vector_dedup._projected(0, {(1, 8): 30}),
                           "table int, label int, dim int, code long, id long, vec array<float>")
    assert {(r["label"], r["n"]) for r in got.groupBy("label").agg({"table": "max"}).toDF(
        "label", "n").collect()} == {(0, 23), (1, 29)}
