"""Secret scans: fixed patterns, and character Markov models of random strings.

Two first-order Markov models over the letters of tokens are trained from labelled
samples of comparable sizes: one of random strings (keys, tokens and digests that the fixed
patterns find, and strings drawn from the usual alphabets), one of ordinary words and the
identifiers made of them. A long token is reported when the logarithm of its likelihood
ratio under the two models passes a threshold per letter. Tokens that a fixed pattern already
covers are not reported twice. Only DataFrame and SQL functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The patterns whose spans every scan reports, in their order.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LETTERS = 12
#: The access and hex patterns with their least lengths: a shorter match has no longer part.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")

#: Tokens that the models judge, and the letters they know: code points 43 to 122.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ORDINARY = r"[A-Za-z0-9_-]{6,}"
FIRST_LETTER, LETTERS = 43, 80
#: Weight of the uniform distribution per letter, in letters seen.
SMOOTHING = 64.0
#: Least log-likelihood ratio of a reported token, per pair of neighbouring letters.
THRESHOLD = 1.5
#: Documents that labelled samples are taken from, at most about.
RANDOM_DOCS, ORDINARY_DOCS = 50_000, 4_000
#: Alphabets of keys, tokens and digests; the random class draws DRAWN strings from each.
DIGITS, SMALL = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = (
    DIGITS + "abcdef",
    DIGITS + "ABCDEF",
    SMALL.upper() + "234567",
    SMALL + "234567",
    DIGITS + SMALL,
    DIGITS + SMALL.upper(),
    DIGITS + SMALL + SMALL.upper(),
    DIGITS + SMALL + SMALL.upper() + "+/",
    DIGITS + SMALL + SMALL.upper() + "-_",
)
DRAWN, DRAWN_LETTERS = 2_000, 40
#: Words from this length on are what the models have to judge, so they have no label.
UNLABELLED = 20
#: Words that are joined to one identifier.
JOINED = 8
#: A short part four times or more in a row says nothing about randomness after its first time.
REPEATED = r"(.{1,8}?)\1{3,}"
MASK = "[SECRET]"


def _find(text: Column, pattern: str, kind: str) -> Column:
    """Spans (start, stop, kind, hit) of the leftmost non-overlapping matches, by code point."""
    none = F.expr("CAST(array() AS array<struct<start: int, stop: int, kind: string, hit: string>>)")
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
    )

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.char_length(pair["gap"])
        stop = start + F.coalesce(F.char_length(pair["hit"]), F.lit(0))
        span = F.struct(
            start.alias("start"), stop.alias("stop"), F.lit(kind).alias("kind"), pair["hit"].alias("hit")
        )
        spans = F.when(pair["hit"].isNull(), state["spans"]).otherwise(
            F.concat(state["spans"], F.array(span))
        )
        return F.struct(stop.alias("at"), spans.alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    walked = F.aggregate(zipped, begin, step, lambda state: state["spans"])
    return F.when(text.rlike(pattern), walked).otherwise(none)


def _base(text: Column) -> Column:
    def long_enough(span: Column) -> Column:
        return F.char_length(F.regexp_extract(span["hit"], ASSIGN, 2)) >= ASSIGN_LETTERS

    return F.concat(
        F.filter(_find(text, ASSIGN, KINDS[0]), long_enough),
        _find(text, ACCESS, KINDS[1]),
        _find(text, HEX, KINDS[2]),
    )


def _sampled(rows: DataFrame, most: int, draw: Column) -> DataFrame:
    total = rows.count()
    if total <= most:
        return rows
    return rows.where(F.pmod(draw, F.lit(1 << 30)) < int((1 << 30) * most / total))


def _drawn(docs: DataFrame, seed: int) -> DataFrame:
    """(token): DRAWN hash-random strings of each alphabet."""
    alphabet = F.element_at(
        F.array(*map(F.lit, ALPHABETS)), (F.col("id") % len(ALPHABETS) + 1).cast("int")
    )

    def letter(i: Column) -> Column:
        place = F.pmod(F.xxhash64(F.lit(seed), "id", i), F.length("alphabet"))
        return F.substring("alphabet", (place + 1).cast("int"), F.lit(1))

    letters = F.transform(F.sequence(F.lit(1), F.lit(DRAWN_LETTERS)), letter)
    numbers = docs.sparkSession.range(DRAWN * len(ALPHABETS)).select("id", alphabet.alias("alphabet"))
    return numbers.select(F.array_join(letters, "").alias("token"))


def _identifiers(words: Column) -> Column:
    """Words joined to identifiers in the usual ways, with numbers between them."""

    def piece(word: Column, i: Column) -> Column:
        number = F.pmod(F.xxhash64(word), F.lit(1 << 31))
        ways = F.array(
            F.concat(F.lit("-"), word),
            F.concat(F.lit("_"), word),
            F.concat(F.lit("/"), word),
            F.concat(F.lit("="), word),
            F.initcap(word),
            F.concat((number % 10_000).cast("string"), F.lit("-")),
            F.concat(F.lit("_"), F.upper(word)),
            F.concat(F.lit("/"), number.cast("string")),
        )
        return F.element_at(ways, (i + 1).cast("int"))

    # Without a word, the one identifier is empty.
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1)), F.lit(JOINED)),
        lambda first: F.array_join(F.transform(F.slice(words, first, JOINED), piece), ""),
    )


def labelled_samples(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 19
) -> DataFrame:
    """(token, random): random strings, and ordinary words and identifiers.

    Random are the first letters of about DRAWN distinct strings that the fixed patterns find,
    and as many drawn from each of ALPHABETS, so neither the corpus nor one kind of
    secret in it outweighs the others. Ordinary are the other words of fewer than UNLABELLED
    letters, once as they stand and once joined to identifiers. Documents are a
    hash sample of about RANDOM_DOCS and ORDINARY_DOCS.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def draw(seed: int) -> Column:
        return F.xxhash64(F.lit(seed), "key", F.length("text"))

    hits = _sampled(rows, RANDOM_DOCS, draw(seed)).select(F.explode(_base(F.col("text"))).alias("span"))
    value = F.when(F.col("span.kind") == KINDS[0], F.regexp_extract("span.hit", ASSIGN, 2)).otherwise(
        F.col("span.hit")
    )
    found = hits.select(F.substring(value, 1, DRAWN_LETTERS).alias("token")).distinct()
    random = _sampled(found, DRAWN, F.xxhash64(F.lit(seed), "token")).union(_drawn(docs, seed))
    bare = F.regexp_replace(
        F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " "
    )
    words = _sampled(rows, ORDINARY_DOCS, draw(seed + 1)).select(
        F.filter(
            F.regexp_extract_all(bare, F.lit(ORDINARY), F.lit(0)), lambda w: F.length(w) < UNLABELLED
        ).alias("words")
    )
    ordinary = words.select(F.explode(F.concat("words", _identifiers(F.col("words")))).alias("token"))
    return random.select("token", F.lit(True).alias("random")).union(
        ordinary.select("token", F.lit(False).alias("random"))
    )


def _codes(token: Column) -> Column:
    """Letter numbers of a token; letters outside the alphabet become its first one."""
    return F.transform(
        F.split(token, ""),
        lambda c: F.when(
            F.ascii(c).between(FIRST_LETTER, FIRST_LETTER + LETTERS - 1), F.ascii(c) - FIRST_LETTER
        ).otherwise(0),
    )


def train(samples: DataFrame) -> str:
    """Logarithms of the ratio of transition probabilities, row by row, comma-separated.

    `samples` has token and random (true: random string). The table has LETTERS x LETTERS
    numbers whatever the samples; without samples of a class that class is uniform.
    """
    codes = samples.where("length(token) > 1").select("random", _codes(F.col("token")).alias("c"))
    pairs = codes.select(
        "random", F.explode(F.transform(F.sequence(F.lit(1), F.size("c") - 1), lambda i: F.struct(
            F.element_at("c", i).alias("a"), F.element_at("c", i + 1).alias("b")
        ))).alias("p")
    )
    counted = pairs.groupBy("random", "p.a", "p.b").agg(F.count("*").alias("n"))
    counts = {True: {}, False: {}}
    for row in counted.collect():  # at most 2 x LETTERS x LETTERS rows
        counts[row["random"]][row["a"], row["b"]] = row["n"]
    sums = {
        kind: [sum(counts[kind].get((a, b), 0) for b in range(LETTERS)) for a in range(LETTERS)]
        for kind in counts
    }

    def share(kind: bool, a: int, b: int) -> float:
        seen = counts[kind].get((a, b), 0) + SMOOTHING / LETTERS
        return seen / (sums[kind][a] + SMOOTHING)

    return ",".join(
        f"{math.log(share(True, a, b) / share(False, a, b)):.4f}"
        for a in range(LETTERS)
        for b in range(LETTERS)
    )


def log_ratio(token: Column, model: str) -> Column:
    """The log-likelihood ratio of a token: random string against ordinary identifier."""
    table = F.split(F.lit(model), ",").cast("array<double>")
    begin = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

    def step(state: Column, code: Column) -> Column:
        gain = F.element_at(table, (state["last"] * LETTERS + code + 1).cast("int"))
        total = state["sum"] + F.when(state["last"] < 0, F.lit(0.0)).otherwise(gain)
        return F.struct(code.alias("last"), total.alias("sum"))

    return F.aggregate(_codes(token), begin, step, lambda state: state["sum"])


def scan_secrets(
    docs: DataFrame,
    model: str,
    key: str = "doc_id",
    text: str = "text",
    *,
    threshold: float = THRESHOLD,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(key, base, added [, kept]) of every row: arrays of start, stop, kind, hit by code point.

    `base` has the matches of the fixed patterns, `added` the tokens that the models call
    random, without those that a base span touches; parts that only repeat count for nothing. A null text is empty and has neither.
    Repeated rows are scanned one by one. Columns other than key and text are read only as
    the struct `kept` of the columns in `keep`.
    """
    rows = docs.select(
        F.col(key).alias("key"),
        F.struct(*keep).alias("kept") if keep else F.lit(0).alias("kept"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    found = rows.select("key", "kept", _base(F.col("text")).alias("base"), _find(F.col("text"), CANDIDATE, KINDS[3]).alias("long"))

    def apart(span: Column) -> Column:
        touched = F.exists(
            "base", lambda b: (b["start"] < span["stop"]) & (span["start"] < b["stop"])
        )
        return ~touched

    judged = found.select("key", "kept", "base", F.filter("long", apart).alias("long"))
    return judged.select(
        F.col("key").alias(key),
        *(["kept"] if keep else []),
        "base",
        F.filter(
            "long",
            lambda s: log_ratio(F.regexp_replace(s["hit"], REPEATED, "$1"), model)
            >= threshold * (F.char_length(s["hit"]) - 1),
        ).alias("added"),
    )


def _ordered(spans: Column) -> Column:
    """Spans by start, then by kind as listed."""
    kinds = F.array(*map(F.lit, KINDS))
    keyed = F.transform(
        spans,
        lambda s: F.struct(s["start"], F.array_position(kinds, s["kind"]).alias("k"), s["stop"], s["kind"]),
    )
    return F.array_sort(keyed)


def _written(spans: Column) -> Column:
    return F.array_join(
        F.transform(_ordered(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ","
    )


def secret_report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """One flat row per scanned row: counts, digest of the base spans, all spans as text."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        key,
        *(count(kind) for kind in KINDS[:3]),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.concat("base", "added")).alias("spans"),
    )


def with_masks(
    found: DataFrame, docs: DataFrame, text: str = "text", mask: str = MASK
) -> DataFrame:
    """The rows of `docs` that a scan with keep=docs.columns has kept, each span replaced by `mask`.

    Spans that overlap get one mask. A column n_chars is counted anew where a text changes.
    """
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    whole = F.col(f"kept.{text}")

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(whole, state["at"] + 1, span["start"] - state["at"])
        out = F.when(span["start"] >= state["at"], F.concat(state["out"], gap, F.lit(mask))).otherwise(
            state["out"]
        )
        return F.struct(F.greatest(state["at"], span["stop"]).alias("at"), out.alias("out"))

    masked = F.aggregate(
        _ordered(F.concat("base", "added")),
        begin,
        step,
        lambda s: F.concat(s["out"], F.substring(whole, s["at"] + 1, F.lit(2147483647))),
    )
    some = F.size("base") + F.size("added") > 0
    changed = found.select("kept", F.when(some, masked).alias("masked"))
    columns = {c: F.col(f"kept.{c}") for c in docs.columns}
    columns[text] = F.coalesce("masked", columns[text])
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.coalesce(F.char_length("masked").cast(kind), columns["n_chars"])
    return changed.select(*(column.alias(name) for name, column in columns.items()))
