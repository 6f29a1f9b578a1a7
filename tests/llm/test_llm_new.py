"""Conversation repair, n-gram join and vector codes against brute force; stages keep rows whole."""

from __future__ import annotations

import random

import pytest
import llm_brute_new as brute
import llm_tables as tables
from llm_brute import groups

from faultline.llm import codes, dialogues, mixing, neardup, ngramjoin

FIELDS = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
CONVERSATIONS = "conv_id long, turn long, role string, text string, piece long, word string, cost long"


def talk(seed=4):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", None, "", "unit", "User"]
    texts = ["Hello.", "hi", "", None, "  \n", "x. ", "Yes!\t", "No?", "long " * 5000]
    rows = []
    for c in range(150):
        for t in range(draw.randrange(0, 10)):
            rows.append((c or None, draw.choice([t, t, None, t // 2]), draw.choice(roles), draw.choice(texts)))
    for t in range(400):  # one conversation of many pieces
        rows.append((999, t, draw.choice(roles[:4]), f"{draw.choice(['Said', 'cut'])} {draw.randrange(900)}{draw.choice('. ')}"))
    return rows + [rows[5]] * 40


@pytest.mark.parametrize("fan, damage", [(256, True), (3, False)])
def test_conversation_repair(spark, monkeypatch, fan, damage):
    monkeypatch.setattr(dialogues, "FAN", fan)
    rows = talk()
    table = spark.createDataFrame([(*r, 1, "w", 2) for r in rows], CONVERSATIONS).repartition(4)
    found = dialogues.repaired_report(table, damage=damage).collect()
    got = {r["conv_id"]: tuple(r[c] for c in FIELDS) for r in found}
    assert got == brute.conversations(rows, damage) and len(found) == len(got)


def test_no_conversations(spark):
    assert dialogues.repaired_report(spark.createDataFrame([], CONVERSATIONS)).count() == 0


def test_words_with_a_common_end_share_nodes():
    import pyarrow as pa

    words = sorted(["uauS", "auS", "xuS", "uS", ""], key=lambda w: w[::-1])
    made = []
    plain = dialogues.before_suffix
    dialogues.before_suffix = lambda e, s: made.append(1) or plain(e, s)
    try:
        list(dialogues.word_graph([pa.RecordBatch.from_pydict({"word": words})]))
    finally:
        dialogues.before_suffix = plain
    assert len(made) == 5  # S, uS, auS, uauS and xuS


def near_copies():
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [draw.choice(vocabulary) for _ in range(80)]
    passage = " ".join(draw.choice(vocabulary) for _ in range(12))
    rows = []
    for i in range(300):
        own = list(base)
        for _ in range(draw.randrange(0, 4)):
            own[draw.randrange(80)] = f"z{draw.randrange(100000)}"
        rows.append((i, (passage + " ") * (i % 2) + " ".join(own)))
    for i in range(300, 500):
        rows.append((i, passage + " " + " ".join(draw.choice(vocabulary) for _ in range(draw.randrange(0, 40)))))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("crowd, block, dense", [(16, 2048, 4), (4, 40, 0)])
def test_ngram_join(spark, monkeypatch, crowd, block, dense):
    for name, value in (("CROWD", crowd), ("BLOCK_ROWS", block), ("DENSE", dense)):
        monkeypatch.setattr(ngramjoin, name, value)
    rows = near_copies()
    got = ngramjoin.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == groups(dict(rows), 3, 90)


def test_ngram_join_of_awkward_documents(spark):
    docs = tables.documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = ngramjoin.jaccard_groups(docs).collect()
    assert len(got) == len(rows)
    ids = [i for i, _ in rows]
    wanted = groups({i: t for i, t in rows if i is not None}, 3, 90)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        elif ids.count(r["doc_id"]) == 1:
            assert (r["n_shingles"], r["component_id"]) == wanted[r["doc_id"]]
    assert ngramjoin.jaccard_groups(tables.no_documents(spark)).count() == 0


def test_vector_codes(spark, monkeypatch):
    monkeypatch.setattr(codes, "BLOCK", 150)
    draw = random.Random(5)
    rows = [(i, [draw.gauss(0, 0.1) for _ in range(10)], draw.choice([1, 2, None])) for i in range(600)]
    same = [0.1] * 10
    rows += [(5000 + i, same, 1) for i in range(200)] + [rows[3]] * 9 + [(None, same, None), (7000, None, 1), (7001, [], 1)]
    rows += [(7002, [float("nan")] * 10, 1), (7003, [1.0, None] + [0.0] * 8, 2), (7004, [1.0, 2.0], 1)]
    schema = "vec_id long, embedding array<double>, label int, id long, code string"
    table = spark.createDataFrame([(*r, 1, "c") for r in rows], schema).repartition(4)
    got = sorted((str(r[0]), *tuple(r)[1:]) for r in codes.code_report(table).collect())
    assert got == brute.codes(rows)
    assert codes.code_report(table.limit(0)).count() == 0


def test_balls_skip_work_and_stay_exact():
    import numpy as np

    draw = np.random.default_rng(1)
    entries = np.floor(draw.normal(0, 4000, (64, 4)))
    x = np.floor(entries[draw.integers(0, 64, 3000)] + draw.normal(0, 300, (3000, 4)))
    own, far = codes.nearest_of_all(x, entries)
    moved = entries + np.floor(draw.normal(0, 20, entries.shape))
    radii = np.sqrt([far[own == e].max(initial=0) for e in range(64)]) + np.sqrt(((moved - entries) ** 2).sum(axis=1))
    balls = codes.Balls(moved, radii)
    best, error = balls.assign(x, own)
    wanted, least = codes.nearest_of_all(x, moved)
    assert (best == wanted).all() and (error == least).all()
    assert balls.compared < 0.2 * x.shape[0] * 64


def test_unlike_rows_of_one_id_both_stay(spark):
    a, b, c = (" ".join(f"{w}{i}" for i in range(50)) for w in "uwx")
    rows = [(3, a, 1), (3, b, 2), (3, a, 1), (4, b, 4), (5, c, 5), (6, c, 6), (None, a, 7), (7, None, 8), (2, b.upper(), 9)]
    table = spark.createDataFrame(rows, "doc_id long, text string, kept_key int")
    got = sorted((r["doc_id"] or -1, r["kept_key"]) for r in neardup.one_of_each_group(table).collect())
    assert got == [(-1, 7), (2, 9), (3, 1), (5, 5), (7, 8)]


def test_no_document_of_the_mix_is_cut(spark):
    rows = [(1, "w " * 20000, "a"), (2, "x " * 30, "a"), (3, "y " * 500, "b"), (4, None, "b")]
    got = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert got and all(r["text"] == rows[r["doc_id"] - 1][1] for r in got)
