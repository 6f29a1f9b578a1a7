"""Operators on documents against plain Python, on a table of awkward cases and an empty one."""

from __future__ import annotations

import json
from collections import Counter, defaultdict

import llm_brute as brute
import numpy as np
import public_tokenizers
import pytest
import llm_tables as tables
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from faultline.llm import langid, licences, mixing, neardup, packing, pfor, quality, secretscan
from faultline.llm.tokens import PieceEncoder

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return tables.documents(spark).repartition(5).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return docs.collect()


@pytest.fixture(scope="module")
def none(spark):
    return tables.no_documents(spark)


@pytest.mark.parametrize("path, blanks", [(BYTES, True), (WORDS, False)])
def test_pieces_give_the_ids_of_whole_texts(rows, path, blanks):
    plain = Tokenizer.from_file(path)
    own = PieceEncoder(path, blanks, remembered=200)
    texts = [r["text"] or "" for r in rows if len(r["text"] or "") < 50_000]
    texts += ["", " ", "  ", "a  b", "a\t b\n\nc ", " x", "x\n", "a\n\n b", "\x00a b\x00 c\x01d", "\x01a"]
    texts += ["\x1c a\x1cb", "a\r\nb", "　x  y", "é ́x", "don't 's", "1 2 345", "\nA\nB,"]
    for text in texts * 2:
        assert own.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_language(docs, rows, none):
    model = langid.train(docs, sample_key="doc_id")
    assert model["lang"].tolist() == ["de", "en", "fr"]
    found = langid.predict(docs, model).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in rows)
    texts = {r["doc_id"]: (r["text"], r["lang"]) for r in rows if r["doc_id"] not in (11, None)}
    for r in found:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in texts:
            text, lang = texts[r["doc_id"]]
            if not any(c.isalpha() for c in text or ""):
                assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            elif r["doc_id"] < 60:
                assert r["lang_pred"] == lang
    assert langid.predict(none, model).count() == 0
    empty = langid.train(none)
    assert {r["lang_pred"] for r in langid.predict(docs, empty).collect()} == {"und"}


def test_language_vectors_are_bound_and_bundled_as_described():
    letters = sorted(set("abçde"))
    table = langid.letter_vectors(np.array([0, *map(ord, letters)]), 1024, 7).astype(int)
    number = {" ": 0} | {c: i + 1 for i, c in enumerate(letters)}
    line = " ab çd e "
    wanted = sum(
        np.roll(table[number[line[i]]], 2) * np.roll(table[number[line[i + 1]]], 1) * table[number[line[i + 2]]]
        for i in range(len(line) - 2)
    )
    got = langid.bundle(["Ab, çd 1 e", "", "x"], 3, 1024, 7)
    assert np.array_equal(got[0], wanted) and not got[1].any()


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates(docs, rows, width):
    found = neardup.near_duplicates(docs, width=width).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in rows)
    keyed = {}
    for r in rows:
        if r["doc_id"] is not None and r["doc_id"] != 11:
            keyed[r["doc_id"]] = r["text"]
    wanted = brute.groups(keyed, width)
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        elif r["doc_id"] in wanted:
            assert (r["n_shingles"], r["component_id"]) == wanted[r["doc_id"]] or wanted[r["doc_id"]][1] == 51
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_near_duplicate_chain_in_a_crowded_band(spark):
    """Neighbours of a chain are linked, its ends are not alike: one group all the same."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 100])) for i in range(40)]
    rows += [(100 + i, " ".join(words[:60] + [f"u{i}_{j}" for j in range(60)])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs, width=4).collect()}
    assert got == brute.groups(dict(rows), 4)
    assert {got[i][1] for i in range(40)} == {0}


def test_one_of_each_group_keeps_columns_and_one_row_per_key(docs, none):
    kept = neardup.one_of_each_group(docs)
    assert kept.columns == docs.columns
    keys = Counter(r["doc_id"] for r in kept.select("doc_id").collect())
    assert keys.pop(None) == 2 and set(keys.values()) == {1}
    assert {100, 400, 401, 406} <= set(keys) and not {101, 102, 201, 301} & set(keys)
    assert neardup.one_of_each_group(none).count() == 0
    assert neardup.near_duplicates(none).count() == 0


@pytest.fixture(scope="module")
def markov(spark):
    sample = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return secretscan.train(secretscan.labelled_samples(sample))


def test_secrets(docs, rows, none, markov):
    model = markov
    scan = secretscan.scan_secrets(docs, model)
    found = secretscan.secret_report(scan).collect()
    wanted = Counter((r["doc_id"], *brute.secret_row(r["text"])[0]) for r in rows)
    assert Counter(tuple(r)[:5] for r in found) == wanted
    base = {r["doc_id"]: brute.secret_row(r["text"])[1] for r in rows if r["doc_id"] is not None}
    for r in found:
        own = set(filter(None, r["spans"].split(",")))
        assert set(filter(None, base.get(r["doc_id"], "").split(","))) <= own or r["doc_id"] == 11
    added = {r["doc_id"]: [s["hit"] for s in r["added"]] for r in scan.where("size(added) > 0").collect()}
    assert added == {505: ["ghp_x9Kd82LmQz7Vt4RwY1bN6cJ0fH3sP5aUeT"]}
    assert secretscan.secret_report(secretscan.scan_secrets(none, model)).count() == 0
    assert len(secretscan.train(secretscan.labelled_samples(none)).split(",")) == 6400


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_secrets_of_every_alphabet_are_found(spark, sf):
    small, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    alphabets = {
        "upper hex": (digits + "ABCDEF", 40),
        "upper base32": (small.upper() + "234567", 40),
        "lower base32": (small + "234567", 40),
        "base36": (digits + small, 40),
        "upper base36": (digits + small.upper(), 40),
        "base62": (digits + small + small.upper(), 24),
        "base64": (digits + small + small.upper() + "+/", 40),
        "letters": (small + small.upper(), 40),
    }
    draw = np.random.default_rng(11)
    rows = [
        (kind, "see " + "".join(draw.choice(list(letters), n)) + " here")
        for kind, (letters, n) in alphabets.items()
        for _ in range(200)
    ]
    plain = "x" * 90, "xy" * 20, "-=" * 20, "src/main/stand_there", "MAX_THEIR_WHICH_OTHER_COUNT", "2024-01-15-then-them"
    rows += [("plain", text) for text in plain]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    model = secretscan.train(secretscan.labelled_samples(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")))
    scanned = secretscan.scan_secrets(docs, model).where("size(added) + size(base) > 0")
    found = Counter(r["doc_id"] for r in scanned.collect())
    assert found["plain"] == 0
    assert {kind: found[kind] for kind in alphabets if found[kind] < 190} == {}


def test_labelled_samples_are_of_comparable_sizes(spark):
    """Many secrets of one kind, or one secret many times, do not fill the random class."""
    lines = [(i, f"alpha beta gammas token = {i:040x} deltas") for i in range(20_000)]
    docs = spark.createDataFrame(lines, "doc_id long, text string").union(
        spark.range(5_000).selectExpr("id", "'token = 0123456789abcdef0123'")
    )
    samples = secretscan.labelled_samples(docs).where("random")
    total = samples.count()
    assert total - secretscan.DRAWN * len(secretscan.ALPHABETS) < 1.2 * secretscan.DRAWN
    assert samples.where("token like '%0123456789abcdef0123%'").count() <= 1


def test_secret_log_ratio_is_the_models_ratio(spark):
    samples = [("q9x7z8k2", True), ("7q8x9z2k", True), ("banana", False), ("bandana", False)]
    model = secretscan.train(spark.createDataFrame(samples, "token string, random boolean"))
    counts = {True: defaultdict(int), False: defaultdict(int)}
    for token, kind in samples:
        for a, b in zip(token, token[1:], strict=False):
            counts[kind][a, b] += 1

    def share(kind, a, b):
        total = sum(n for (x, _), n in counts[kind].items() if x == a)
        return (counts[kind][a, b] + 64 / 80) / (total + 64)

    for token in ("banana", "q9x7", "zz"):
        wanted = sum(np.log(share(True, a, b) / share(False, a, b)) for a, b in zip(token, token[1:], strict=False))
        got = spark.range(1).select(secretscan.log_ratio(F.lit(token), model).alias("x")).first()["x"]
        assert got == pytest.approx(wanted, abs=1e-3)


def test_masks_replace_spans_only(docs, rows, none, markov):
    model = markov
    scan = secretscan.scan_secrets(docs, model, keep=tuple(docs.columns))
    got = secretscan.with_masks(scan, docs)
    assert got.columns == docs.columns and got.schema == docs.schema
    changed = {r["doc_id"]: r for r in got.where("text LIKE '%[SECRET]%'").collect()}
    assert set(changed) == {503, 504, 505}
    assert changed[505]["text"] == "[SECRET] and interoperabilityconsiderations42x"
    assert changed[505]["n_chars"] == len(changed[505]["text"])
    plain = Counter((r["doc_id"], r["text"]) for r in rows if r["doc_id"] not in changed)
    assert Counter((r["doc_id"], r["text"]) for r in got.collect() if r["doc_id"] not in changed) == plain
    empty = secretscan.scan_secrets(none, model, keep=tuple(none.columns))
    assert secretscan.with_masks(empty, none).count() == 0


def test_licences(docs, rows, none):
    found = licences.licence_report(licences.scan_licences(docs)).collect()
    got = Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in found)
    assert got == Counter((r["doc_id"], *brute.licence_row(r["text"])) for r in rows)
    labels = {r["doc_id"]: (r["labels"], r["score"]) for r in found}
    assert labels[500] == ("apache-2,cc-by-nc,mit", 1.0)
    assert labels[501] == ("mit", 1.0)
    assert labels[0] == ("", 0.0)
    assert licences.scan_licences(none).count() == 0


def test_licence_notice_needs_its_key_phrases(spark):
    whole = " ".join(licences.NOTICES[0].words)
    texts = [whole, whole.replace("hereby", "never"), "x y " + " ".join(whole.split()[:15]), whole.replace("copy", "c")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licences.licence_report(licences.scan_licences(docs)).collect()}
    assert got == {0: "mit", 1: "", 2: "mit", 3: "mit"}


def test_licence_names_in_short_lines(spark):
    lines = {
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "Covered by the GNU Lesser General Public License": "lgpl",
        "Mozilla Public License, version 2.0": "mpl,mpl-2",
        "Mozilla Public License 1.1": "mpl",
        "See LICENSE (3-clause BSD license).": "bsd",
        "A general public license of GNU": "",
    }
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = licences.licence_report(licences.scan_licences(docs)).collect()
    assert {r["doc_id"]: r["labels"] for r in found} == dict(enumerate(lines.values()))
    assert {(r["n_base"], r["base_labels"]) for r in found} == {(0, "")}


def test_licence_notice_without_its_rarest_word(spark):
    """Whatever word of a notice no document holds, the rest of it counts."""
    apache = next(t for t in licences.NOTICES if t.label == "apache-2")
    key = set(apache.keys[0])
    texts = [" ".join(apache.words).replace("http", "https")]
    texts += [" ".join("other" if w == lost else w for w in apache.words) for lost in set(apache.words) - key]
    texts += [" ".join(w for w in apache.words if w != "http"), " ".join(apache.words[6:])]
    one_by_one = [
        licences.licence_report(licences.scan_licences(spark.createDataFrame([(0, t)], "doc_id long, text string")))
        for t in (texts[0], texts[-2])
    ]
    assert [r.first()["labels"] for r in one_by_one] == ["apache-2"] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = licences.licence_report(licences.scan_licences(docs)).collect()
    assert {r["doc_id"]: r["labels"] for r in found} == dict.fromkeys(range(len(texts)), "apache-2")


def test_licence_starts_are_those_of_trying_all():
    draw = np.random.default_rng(5)
    letters = list("abcdefgh")
    made = [tuple(draw.choice(letters, n)) for n in (1, 3, 6, 9, 10, 12)]
    made = [licences.Template(f"t{i}", w, (w[i // 2 : i // 2 + 1],), 0.6) for i, w in enumerate(made)]
    made += [licences.Template("none", tuple("abcab"), (), 0.5), licences.phrase("all", "b c d")]
    for frequency in ({}, {"a": 9, "b": 5, "c": 1}):
        index = licences.Index(tuple(made), frequency, 9)
        files = [draw.integers(-1, len(index.words), draw.integers(0, 40)) for _ in range(80)]
        cut = np.concatenate([[0], np.cumsum([len(f) for f in files])])
        chosen = index.candidates(np.concatenate(files), cut)
        some = 0
        for row, file in enumerate(files):
            words = [index.words[i] if i >= 0 else None for i in file]
            wanted = []
            for t, template in enumerate(made):
                for start in range(-len(template.words), len(words) + 1):
                    stands = [0 <= start + i < len(words) and words[start + i] == w for i, w in enumerate(template.words)]
                    keys = [licences._places(template.words, k)[0] + i for k in template.keys for i in range(len(k))]
                    share = sum(stands) / len(stands)
                    if share >= template.share - 1e-9 and all(stands[i] for i in keys):
                        wanted.append((t, start, share))
            some += len(wanted)
            got = index.matches(file, chosen[row]) if row in chosen else []
            assert got == sorted(wanted, key=lambda x: (x[1], x[0]))
        assert some > 100


def test_packing(docs, rows, none):
    plain = Tokenizer.from_file(BYTES)
    packed = packing.pack(docs, BYTES, keep_ids=True).collect()
    by_doc = defaultdict(list)
    for r in packed:
        assert r["length"] == len(r["ids"]) and brute.crc(r["ids"]) == r["ids_crc32"]
        by_doc[r["doc_id"]].append(r)
    once = Counter(r["doc_id"] for r in rows)
    for r in rows:
        if once[r["doc_id"]] == 1:
            ids = brute.ids_of(plain, r["text"], 0)
            pieces = sorted(by_doc[r["doc_id"]], key=lambda p: p["piece"])
            assert [p["piece"] for p in pieces] == list(range(len(pieces)))
            assert np.concatenate([p["ids"] for p in pieces]).tolist() == ids.tolist()
            assert all(p["length"] == 2048 for p in pieces[1:])
            assert [p["start"] for p in pieces] == np.cumsum([0, *(p["length"] for p in pieces)])[:-1].tolist()
    total = sum(r["length"] for r in packed)
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["fixed"] or r["length"] < 2048
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-total // 2048) + 1
    assert packing.pack(none, BYTES).count() == 0


def test_token_files(spark, docs, rows, none, tmp_path):
    plain = Tokenizer.from_file(WORDS)
    path = str(tmp_path / "tokens")
    pfor.write_tokens(docs, path, WORDS, shard_values=5_000)
    got = pfor.read_tokens(spark, path, keep_ids=True).orderBy("start").collect()
    ordered = sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or ""))
    at = 0
    for r, wanted in zip(got, ordered, strict=True):
        ids = brute.ids_of(plain, wanted["text"], 1)
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (wanted["doc_id"], at, len(ids), brute.crc(ids))
        assert r["ids"] == ids.tolist()
        at += len(ids)
    pfor.write_tokens(none, str(tmp_path / "none"), WORDS)
    assert pfor.read_tokens(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 3000])
@pytest.mark.parametrize("high", [1, 2, 300, 49408, 2**32])
def test_shard_round_trip(n, high):
    draw = np.random.default_rng(n)
    values = draw.integers(0, high, n).astype(np.uint32)
    if n > 10:
        values[draw.integers(0, n, n // 30 + 1)] = draw.integers(0, 2**32, n // 30 + 1)
    shard = pfor.Shard(pfor.encode(values))
    assert np.array_equal(shard.decode(), values)
    for block in range(shard.blocks):
        assert np.array_equal(shard.decode(block, block + 1), values[128 * block : 128 * block + 128])


def test_mixing(docs, rows, none):
    got = mixing.mix(docs).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter(
        zip((r["doc_id"] for r in rows), brute.sizes(r["text"] for r in rows), strict=True)
    )
    by_source = defaultdict(int)
    for r, n in zip(rows, brute.sizes(r["text"] for r in rows), strict=True):
        by_source[r["source"]] += n
    wanted = brute.targets(by_source)
    source = {r["doc_id"]: r["source"] for r in rows if r["doc_id"] not in (None, 11)}
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        if r["doc_id"] in source:
            assert r["target"] == pytest.approx(wanted[source[r["doc_id"]]])
            assert r["source_size"] == by_source[source[r["doc_id"]]]
        taken[round(r["target"], 6), r["source_size"]] += r["taken"]
    for (target, _), n in taken.items():
        assert abs(n - target) <= 3
    assert Counter(mixing.mix(docs.repartition(3)).collect()) == Counter(got)
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0


def test_targets_share_the_excess_again(spark):
    by_source = {"a": 10, "b": 1000, "c": 5, "d": 0, "é": 70, None: 3}
    sizes = spark.createDataFrame(list(by_source.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    assert got == pytest.approx(brute.targets(by_source))


def test_mixed_rows_are_whole_and_near_the_words_taken(docs, rows):
    wanted = defaultdict(int)
    for r in mixing.mix(docs).collect():
        if r["size"]:
            wanted[r["doc_id"]] += r["size"] * ((2 * r["taken"] + r["size"]) // (2 * r["size"]))
    got = mixing.mixed(docs)
    assert got.columns == docs.columns and got.schema == docs.schema
    known = {(r["doc_id"], r["text"], r["n_chars"]) for r in docs.collect()}
    words = defaultdict(int)
    for r in got.collect():
        assert (r["doc_id"], r["text"], r["n_chars"]) in known
        words[r["doc_id"]] += brute.sizes([r["text"]])[0]
    assert dict(words) == {k: n for k, n in wanted.items() if n}


def test_quality(spark, docs, rows, none):
    labels = spark.createDataFrame(
        [(i, 1) for i in range(60)] + [(200 + i, 0) for i in range(30)] + [(400, None), (401, 7), (None, 1)],
        "doc_id long, quality int",
    )
    model = quality.train(docs, labels)
    found = quality.score(docs, model).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in rows)
    assert all(0 <= r["score"] <= 1 for r in found)
    good = np.mean([r["score"] for r in found if r["doc_id"] is not None and r["doc_id"] < 60])
    poor = np.mean([r["score"] for r in found if r["doc_id"] is not None and 200 <= r["doc_id"] < 230])
    assert good > 0.9 > 0.2 > poor
    assert quality.score(none, model).count() == 0
    assert quality.train(docs, labels.where("quality > 9")) is None
    assert {r["score"] for r in quality.score(docs, None).collect()} == {0.5}


def test_isotonic_pools_violators():
    knots, values = quality.isotonic(np.array([0.0, 1.0, 2.0, 3.0]), np.array([1.0, 0.0, 1.0, 1.0]), np.ones(4))
    assert knots.tolist() == [0.5, 2.5] and values.tolist() == [0.5, 1.0]


def test_fourier_features_stand_for_a_gaussian_kernel():
    x = np.random.default_rng(1).normal(size=(40, 6))
    z = quality.fourier(x, 4000, 1.0, 5)[:, :4000]
    far = ((x[:, None] - x[None]) ** 2).sum(axis=-1)
    assert np.abs(z @ z.T - np.exp(-far / 12)).max() < 0.1


def test_held_out_accuracy_of_the_models(spark):
    from faultline.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    lang = QUERIES["op2_language"](spark, sf).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert lang.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good = QUERIES["op9_quality"](spark, sf).where("held_out").join(labels, "doc_id")
    assert good.select(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.9


def test_plan_of_packing_is_optimal_on_small_instances():
    draw = np.random.default_rng(1)

    def fewest(items, capacity):
        best = len(items)

        def place(i, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if i == len(items):
                best = len(rooms)
                return
            for room in sorted({r for r in rooms if r >= items[i]}):
                at = rooms.index(room)
                place(i + 1, [*rooms[:at], room - items[i], *rooms[at + 1 :]])
            place(i + 1, [*rooms, capacity - items[i]])

        place(0, [])
        return best

    for _ in range(150):
        capacity = int(draw.integers(5, 30))
        items = sorted(draw.integers(1, capacity + 1, draw.integers(0, 10)).tolist(), reverse=True)
        counts = np.bincount(np.array(items, int), minlength=capacity + 1)
        fixed, left = packing.reduce_dominated(counts, capacity)
        rest = [x for x in range(capacity, 0, -1) for _ in range(left[x])]
        assert sum(p.number for p in fixed) + fewest(rest, capacity) == fewest(items, capacity)
        plan = packing.make_plan(counts, capacity)
        held = Counter(x for p in plan.patterns for x in p.lengths * p.number)
        assert held == Counter(items)
        assert all(sum(p.lengths) <= capacity for p in plan.patterns)
        assert plan.fixed == sum(p.number for p in fixed)


def test_reduction_of_packing_reaches_every_length():
    def reduced(items, capacity):
        counts = np.bincount(np.array(items), minlength=capacity + 1)
        fixed, left = packing.reduce_dominated(counts, capacity)
        return Counter({tuple(sorted(p.lengths)): p.number for p in fixed}), left

    # The longest piece, 70, has no dominating set; complements below it are fixed all the same.
    fixed, left = reduced([70, 9, 8, 7, 6, 5, 4] + [60, 40] * 5 + [50] * 5, 100)
    assert fixed[40, 60] == 5 and fixed[50, 50] == 2 and left[70] == 1
    # At most two fit beside 80: 11 and 9 fill it.
    assert reduced([80, 11, 9, 8], 100)[0] == Counter({(9, 11, 80): 1, (8,): 1})
    # At most one more fits beside each of them.
    assert reduced([67, 66, 34, 33], 100)[0] == Counter({(33, 67): 1, (34, 66): 1})
    draw = np.random.default_rng(4)
    counts = np.bincount(draw.integers(1, 2049, 20_000), minlength=2049)
    plan = packing.make_plan(counts, 2048)
    in_fixed = sum(len(p.lengths) * p.number for p in packing.reduce_dominated(counts, 2048)[0])
    # At least every piece with a complement, some four fifths of evenly spread lengths.
    pairs = np.minimum(counts[1:1024], counts[2047:1024:-1]).sum() + counts[1024] // 2
    assert in_fixed >= 2 * pairs + counts[2048] > 0.8 * counts.sum()
    assert plan.sequences >= plan.fixed >= pairs + counts[2048]
    assert plan.sequences <= -(-int(counts @ np.arange(2049)) // 2048) * 1.01


@pytest.mark.parametrize("one_text", [False, True])
def test_token_files_split_a_repeated_key(spark, tmp_path, one_text):
    texts = "'same words'" if one_text else "concat('words ', id)"
    docs = spark.range(0, 4000, 1, 4).selectExpr("7L AS doc_id", f"{texts} AS text")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        pfor.write_tokens(docs, str(tmp_path / "t"), WORDS)
    finally:
        spark.conf.set(coalesce, before)
    shards = spark.read.parquet(str(tmp_path / "t")).selectExpr("size(counts) AS n").collect()
    assert sum(r["n"] for r in shards) == 4000 and max(r["n"] for r in shards) < 2000
    got = pfor.read_tokens(spark, str(tmp_path / "t")).orderBy("start").collect()
    ends = [r["start"] + r["n_tokens"] for r in got]
    assert [r["start"] for r in got] == [0, *ends[:-1]]


def test_pipeline_leaves_out_unseen_scripts_and_keeps_short_texts(spark):
    import corpus_pipeline

    draw = np.random.default_rng(2)
    docs = [r[:3] for r in tables.documents(spark).where("doc_id < 60 AND doc_id <> 11").collect()]
    for i in range(60):
        first, letters = ((0x430, 32), (0x3B1, 25), (0x4E00, 2000))[i % 3]
        words = [[chr(first + x) for x in draw.integers(0, letters, 6)] for _ in range(40)]
        docs.append((1000 + i, " ".join(map("".join, words)), None))
    docs += [(2000 + i, t, None) for i, t in enumerate(tables.EN + tables.DE + tables.FR + ["which would, there about other"])]
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, table, "").collect()}
    assert kept == {d for d, _, _ in docs if not 1000 <= d < 2000}


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    sf = str(tmp_path)
    tables.documents(spark).write.parquet(f"{sf}/documents.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, at = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{sf}/{name}")
        docs = at[name] = spark.read.parquet(f"{sf}/{name}")
        if name != "packing":
            assert docs.columns == columns
    assert not {400, 401, 402, 403} & {r["doc_id"] for r in at["language"].collect()}
    keyed = {r["doc_id"]: r["text"] for r in at["language"].where("doc_id <> 11").collect()}
    groups = brute.groups(keyed, 5)
    kept = {r["doc_id"] for r in at["near_duplicates"].where("doc_id <> 11").collect()}
    assert kept == {i for i, (_, g) in groups.items() if g == i} - ({51} & set(keyed)) | (kept & {51})
    for r in at["secrets"].collect():
        assert not brute.secret_spans(r["text"])
    assert at["secrets"].count() == at["near_duplicates"].count()
    total = sum(brute.sizes(r["text"] for r in at["secrets"].collect()))
    # Documents are whole: each source may be off by half of its longest one.
    longest = defaultdict(int)
    for r in at["secrets"].collect():
        longest[r["source"]] = max(longest[r["source"]], brute.sizes([r["text"]])[0])
    off = abs(sum(brute.sizes(r["text"] for r in at["mixing"].collect())) - total)
    assert off <= 10 + sum(longest.values()) / 2
    pieces = at["packing"].collect()
    assert sum(r["piece"] == 0 for r in pieces) == at["mixing"].count()
    result = corpus_pipeline.run(spark, sf)
    assert json.dumps(result.columns) == json.dumps(at["packing"].columns)
    assert result.count() == len(pieces)
