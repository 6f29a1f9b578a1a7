"""Registered queries against their contracts in plain Python, on made-up rows."""

from __future__ import annotations

import random
import re
from collections import Counter

import llm_brute as brute
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from faultline.functions.settle import settle
from faultline.llm import neardup, queries, tokens

LICENCE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}


def licence_row(text):
    words = re.findall(brute.LICENCE_WORD, (text or "").translate(brute.LOWER))
    places = []
    for phrase, label in LICENCE_PHRASES.items():
        wanted = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def test_licence_query_counts_the_phrases_of_its_contract(spark, tmp_path):
    texts = [
        None,
        "",
        " .,\n",
        "MIT License",
        "Released under the MIT License.",
        "the mit license, UNDER-the\x00MIT\tlicense; under the mit licenses",
        "Under the émit license, under thé mit license \x80under the mit license",
        "Apache License, Version 2.0; apache license version 20; CC BY-NC 4.0 cc by nc-sa",
        "x " * 5000 + "under the MIT license" + " y" * 70_000 + " under the MIT license",
    ]
    draw = random.Random(4)
    pieces = "under the mit license Apache VERSION 2 cc by nc é x".split()
    for _ in range(300):
        made = (draw.choice(pieces) + draw.choice(" \n.-\x00\x7f") for _ in range(draw.randrange(60)))
        texts.append("".join(made))
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(None, texts[4]), (4, texts[4]), (4, texts[5])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op5_licences(spark, str(tmp_path)).collect()
    exact = Counter(
        (r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in found
    )
    assert exact == Counter((i, *licence_row(t)) for i, t in rows)
    labels = {r["doc_id"]: r["labels"] for r in found}
    assert labels[3] == "mit" and labels[7] == "apache-2,cc-by-nc"


def chain_rows():
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 100])) for i in range(40)]
    rows += [(100 + i, " ".join(words[:60] + [f"u{i}_{j}" for j in range(60)])) for i in range(30)]
    return rows + [(200, None), (201, ""), (202, "w1 w2"), (203, "w1 w2")]


@pytest.mark.parametrize("sent", [neardup.SENT_KEYS, 0])
def test_near_duplicates_move_no_text_between_tasks(spark, tmp_path, monkeypatch, sent):
    """Unless there are more documents to compare in full than keys may be sent to all tasks."""
    plans = []

    def watched(df):
        mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        plans.append(df._jdf.queryExecution().explainString(mode))
        return settle(df)

    monkeypatch.setattr(neardup, "settle", watched)
    monkeypatch.setattr(neardup, "SENT_KEYS", sent)
    rows = chain_rows()
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = neardup.near_duplicates(docs, width=4).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute.groups(dict(rows), 4)
    moved = re.findall(r"\) (?:Broadcast)?Exchange\s*\nInput \[\d+\]: \[(.*)\]", "\n".join(plans))
    assert moved and any("text#" in columns for columns in moved) == (sent == 0)


def test_empty_texts_of_repeated_keys_link_nothing(spark):
    common = " ".join(f"c{i}" for i in range(30))
    rows = [(i, f"{common} " + " ".join(f"d{i}_{j}" for j in range(12))) for i in (1, 2)]
    docs = spark.createDataFrame([*rows, (1, ""), (2, None)], "doc_id long, text string")
    found = neardup.near_duplicates(docs, width=4).collect()
    assert {(r["doc_id"], r["component_id"]) for r in found} == {(1, 1), (2, 2)}


@pytest.mark.parametrize("name, blanks", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_a_full_table_of_pieces_keeps_those_met_again(monkeypatch, name, blanks):
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    own = tokens.PieceEncoder(path, blanks, remembered=300)
    asked = Counter()
    ids = own._ids
    monkeypatch.setattr(own, "_ids", lambda key: (asked.update([key]), ids(key))[1])
    draw = random.Random(2)
    common = ["x"] + ["".join(draw.choices("abcdeéß", k=5)) for _ in range(100)]
    for _ in range(60):
        rare = ["".join(draw.choices("fghijkö", k=8)) + draw.choice(["", ",", "!"]) for _ in range(40)]
        text = " ".join(["x", *draw.sample(common[1:] + rare, 140)])
        assert own.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids
        assert own.known == len(own.place) <= 300 + 200
    assert max(asked[word] for word in common[1:]) <= 2
