"""Near-duplicate documents by MinHash bands and odd sketches, confirmed on full sets.

A document is the set of its distinct word shingles. Documents with the same set are one
class from the start. A class has 160 MinHash values: 32 bands of 5 propose pairs, and the
parity bitmap of the values (an odd sketch, whose XOR with another one counts their
differences) drops the pairs that are clearly below the limit. What stays is confirmed by
the exact overlap of the full sets. Components of confirmed links are the groups.
Texts are signed where they are read, and read again where full sets are needed: they
are moved between tasks only if there are very many such documents.

A band is not expanded into pairs. Its members meet its smallest member first; bands
whose members have become one component that way are done. In the others only members
outside the band's largest component meet the rest, so every two members of a band that
are not yet connected are compared and no link between different components is lost.
The members of crowded bands get a finer odd sketch of 4096 values for that, and meet
in blocks of bounded size that give out only the pairs whose sketches are close, and each
only in the first band that it shares.
The chance that a pair at the limit shares no band is (1 - 0.8^5)^32 < 4e-6, and that its
sketch fails it below 1e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.settle import settle
from faultline.llm.shipping import send_code
from faultline.llm.components import connected
from faultline.llm.text import (
    LOWER,
    SPACES,
    blocks,
    mix,
    multipliers,
    word_hashes,
    word_limits,
)

BANDS, ROWS = 32, 5
SKETCH_BITS = 512
#: How far below the limit a sketch estimate may lie: five to six standard deviations.
MARGIN = 0.2
CHUNK = 1 << 14
WORD = r"[^\x20\x09-\x0D]"
#: Up to so many repeated keys (8 MB) are sent to all tasks; more are joined by shuffle.
SENT_KEYS = 1_000_000
#: Bands with more members than this compare fine sketches, in blocks of so many members.
CROWD, BLOCK = 8, 256
FINE_SAMPLES, FINE_BITS, FINE_MARGIN = 4096, 4096, 0.05


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text; empty without a word."""
    places = multipliers(width, seed=11)
    short = multipliers(width, seed=12)
    for _, raw, limits in blocks(column):
        data = LOWER[raw]
        starts, ends, cut = word_limits(~SPACES[data], limits)
        words = word_hashes(data, starts, ends)
        whole = np.zeros(max(len(words) - width + 1, 0), np.uint64)
        for j in range(width):
            whole += words[j : j + len(whole)] * places[j]
        whole = mix(whole)
        for first, last in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            if last - first >= width:
                yield np.unique(whole[first : last - width + 1])
            elif last > first:
                own = words[first:last] * short[: last - first]
                yield mix(own.sum(keepdims=True, dtype=np.uint64) + short[last - first - 1])
            else:
                yield np.zeros(0, np.uint64)


def minhash(own: np.ndarray, flip: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set."""
    values = np.full(len(flip), 0xFFFFFFFF, np.uint32)
    high = (own >> np.uint64(32)).astype(np.uint32)
    step = max(1, CHUNK * BANDS * ROWS // len(flip))
    for at in range(0, len(high), step):
        part = (high[None, at : at + step] ^ flip) * times
        values = np.minimum(values, part.min(axis=1))
    return values


def functions(samples: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    flip = (multipliers(samples, seed) >> np.uint64(32)).astype(np.uint32)[:, None]
    return flip, (multipliers(samples, seed + 1) >> np.uint64(31)).astype(np.uint32)[:, None] | 1


def odd_sketch(values: np.ndarray, bit: np.ndarray, bits: int) -> bytes:
    """The parity bitmap of MinHash values."""
    place = mix(values.astype(np.uint64) * bit[0] + bit) % np.uint64(bits)
    odd = np.bincount(place.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


class Signer:
    """MinHash values, band keys, odd sketch and fingerprint of a shingle set."""

    def __init__(self) -> None:
        samples = BANDS * ROWS
        self.flip, self.times = functions(samples, 21)
        self.inside = multipliers(ROWS, 23)
        self.band = multipliers(BANDS, 24)
        self.bit = multipliers(samples, 25)

    def minhash(self, own: np.ndarray) -> np.ndarray:
        return minhash(own, self.flip, self.times)

    def bands(self, values: np.ndarray) -> np.ndarray:
        table = values.astype(np.uint64).reshape(BANDS, ROWS) + np.uint64(1)
        return mix((table * self.inside).sum(axis=1, dtype=np.uint64) + self.band).view(np.int64)

    def sketch(self, values: np.ndarray) -> bytes:
        return odd_sketch(values, self.bit, SKETCH_BITS)

    @staticmethod
    def print_of(own: np.ndarray) -> tuple[int, int]:
        one = mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
        two = mix(own * np.uint64(0xDA942042E4DD58B5) + np.uint64(7)).sum(dtype=np.uint64)
        return int(one.view(np.int64)), int(two.view(np.int64))


def most_odd_bits(
    limit: float, samples: int = BANDS * ROWS, bits: int = SKETCH_BITS, margin: float = MARGIN
) -> int:
    """XOR bits that a pair at `limit - margin` is expected to have; more drop a pair."""
    flips = 2 * samples * (1 - max(limit - margin, 0.0))
    return int(np.ceil(bits / 2 * (1 - (1 - 2 / bits) ** flips)))


_PRINTS = pa.schema(
    [
        ("key", pa.int64()),
        ("n", pa.int64()),
        ("p1", pa.int64()),
        ("p2", pa.int64()),
        ("bands", pa.list_(pa.int64())),
        ("sketch", pa.binary()),
    ]
)
_FINE = pa.schema([("rep", pa.int64()), ("fine", pa.binary())])
_SETS = pa.schema([("rep", pa.int64()), ("items", pa.list_(pa.int64()))])


def _with_rows(make, width):
    """Runs make(key, set) -> row over (key, text) batches, one result batch per input batch."""

    def run(batches):
        kind, row = make
        for batch in batches:
            keys = batch.column(0).to_pylist()
            rows = [row(k, s) for k, s in zip(keys, shingle_sets(batch.column(1), width), strict=True)]
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kind]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], schema=kind
            )

    return run


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row.

    Documents are linked when 100 * shared shingles >= percent * all their shingles. The words
    are the runs without ASCII white space, A-Z in lower case. Fewer words than `width`
    are one shingle; a text without words, or null, has none and is linked with nothing.
    Rows with the same key are one document to the links and are all returned. A row whose
    key is null is returned with a null component and kept. Other columns are not read.
    """
    send_code(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))

    signer = Signer()

    def print_row(k, own):
        if k is None or not len(own):
            return (k, len(own), *Signer.print_of(own), None, None)
        values = signer.minhash(own)
        return (k, len(own), *Signer.print_of(own), signer.bands(values), signer.sketch(values))

    prints = settle(
        rows.mapInArrow(
            _with_rows((_PRINTS, print_row), width),
            "key long, n long, p1 long, p2 long, bands array<long>, sketch binary",
        )
    )
    found = prints.where("n > 0 AND key IS NOT NULL").withColumnRenamed("key", "rep")
    classes = settle(found.groupBy("p1", "p2", "n").agg(F.min("rep").alias("rep")))
    # One row per class brings its signature; rows that repeat a key bring theirs too.
    signed = settle(
        found.select("rep", "bands", "sketch").join(classes.select("rep"), "rep", "left_semi")
    )
    links = _links(signed, rows.withColumnRenamed("key", "rep"), width, percent)
    labels = connected(links)
    named = settle(
        classes.join(labels, classes["rep"] == labels["node"], "left").select(
            "p1", "p2", "n", F.coalesce("component", "rep").alias("component_id")
        )
    )
    # A row whose key repeats with another text follows the smallest of its components.
    joined = prints.join(named, ["p1", "p2", "n"], "left")
    return joined.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNotNull(), F.coalesce("component_id", "key")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def one_of_each_group(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """One row of `docs` for each group, and every row without words or without a key.

    The row with the smallest key of a group stays. Rows that repeat a key with unlike texts are
    documents of their own, so each stays unless its own group has a smaller key; of rows with
    equal key and text one stays. Columns keep their names, whatever they are; an empty table
    stays empty.
    """
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{key}`").cast("long").alias("id"),
        F.col(f"`{text}`").alias("text"),
    )
    ids = held.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("rows"))
    repeated = settle(ids.where("rows > 1").select(F.col("id").alias("own")))
    unlike = repeated.count()
    own = F.col("id")
    if unlike:
        # A repeated key is no name of a row; key and text together are.
        many = F.broadcast(repeated) if unlike <= SENT_KEYS else repeated
        held = held.join(many, held["id"] == many["own"], "left")
        own = F.when(F.col("own").isNotNull(), F.xxhash64("id", "text")).otherwise(F.col("id"))
    held = held.withColumn("name", own)
    found = near_duplicates(held.select("name", "text"), "name", "text", width=width, percent=percent)
    if not unlike:
        winners = found.where("kept AND name IS NOT NULL").select(F.col("name").alias("winner"))
        return held.join(winners, F.col("name") == F.col("winner"), "left_semi").union(
            held.where("name IS NULL")
        ).select("row.*")
    worded = found.where("n_shingles > 0 AND name IS NOT NULL").select("name", "component_id").distinct()
    keys = held.where("id IS NOT NULL").select(F.col("name").alias("named"), "id").distinct()
    winners = settle(
        worded.join(keys, F.col("name") == F.col("named"))
        .groupBy("component_id")
        .agg(F.min(F.struct("id", "name"))["name"].alias("winner"))
    )
    empty = F.coalesce(F.col("id").isNull() | ~F.coalesce("text", F.lit("")).rlike(WORD), F.lit(True))
    kept = held.where(~empty).join(winners, F.col("name") == F.col("winner"), "left_semi")
    alone = kept.where("own IS NULL").select("row")
    one = kept.where("own IS NOT NULL").groupBy("name").agg(F.first("row").alias("row")).select("row")
    return alone.union(one).union(held.where(empty).select("row")).select("row.*")


def _links(signed: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) that connect all classes which a chain of links connects."""
    sketches = signed.select("rep", "sketch")
    in_band = signed.select("rep", F.explode("bands").alias("band"))
    # Only bands with several members are kept, each with its smallest one.
    met = settle(
        in_band.groupBy("band")
        .agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
        .where("low < high")
        .select("band", "low")
    )
    members = settle(in_band.join(met, "band").select("band", "low", "rep"))

    tried = settle(
        members.where("rep <> low").select(F.col("low").alias("a"), F.col("rep").alias("b")).distinct()
    )
    links = confirmed(tried, sketches, texts, width, percent)
    grouped = connected(links)
    labelled = settle(
        members.join(grouped, members["rep"] == grouped["node"], "left").select(
            "band", "rep", F.coalesce("component", "rep").alias("part")
        )
    )
    parts = labelled.groupBy("band", "part").agg(F.count("*").alias("held"))
    largest = settle(
        parts.groupBy("band")
        .agg(
            F.max(F.struct("held", "part")).alias("most"),
            F.sum("held").alias("members"),
            F.count("*").alias("parts"),
        )
        .where("parts > 1")
        .select("band", "members", F.col("most.part").alias("main"))
    )
    open_rows = settle(labelled.join(largest, "band"))
    few = _across(open_rows.where(F.col("members") <= CROWD))
    many = _close_in_crowds(
        open_rows.where(F.col("members") > CROWD), signed.select("rep", "bands"), texts, width, percent
    )
    rest = few.union(many).distinct()
    rest = rest.join(tried, ["a", "b"], "left_anti")
    return links.union(confirmed(settle(rest), sketches, texts, width, percent))


def _across(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of each small band: a member outside the main component, and one of another."""
    outside = rows.where("part <> main").select(
        "band", F.col("rep").alias("x"), F.col("part").alias("px")
    )
    return (
        rows.join(outside, "band")
        .where(F.col("part") != F.col("px"))
        .select(F.least("rep", "x").alias("a"), F.greatest("rep", "x").alias("b"))
    )


def _chosen(texts: DataFrame, reps: DataFrame, most: int) -> DataFrame:
    """The rows of `texts` whose rep is among `reps`, which has at most `most` rows."""
    wanted = reps.select("rep").distinct()
    if most <= SENT_KEYS:
        wanted = F.broadcast(wanted)
    return texts.join(wanted, "rep", "left_semi").select("rep", "text")


def _close_in_crowds(
    rows: DataFrame, bands: DataFrame, texts: DataFrame, width: int, percent: int
) -> DataFrame:
    """The pairs that _across means, of crowded bands, if their fine sketches are close.

    Members and outside members of a band are dealt into blocks by hash; each two blocks
    meet in one group of at most about 2 x BLOCK rows.
    """
    flip, times = functions(FINE_SAMPLES, 31)
    bit = multipliers(FINE_SAMPLES, 33)
    limit = most_odd_bits(percent / 100, FINE_SAMPLES, FINE_BITS, FINE_MARGIN)
    words = FINE_BITS // 64

    def fine_row(k, own):
        return (k, odd_sketch(minhash(own, flip, times), bit, FINE_BITS))

    fine = settle(
        _chosen(texts, rows, rows.count())
        .mapInArrow(_with_rows((_FINE, fine_row), width), "rep long, fine binary")
        .dropDuplicates(["rep"])
    )
    known = settle(bands.dropDuplicates(["rep"]).join(fine, "rep"))
    sketched = rows.join(known, "rep").withColumn(
        "blocks", F.ceil(F.col("members") / BLOCK).cast("long")
    )
    own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    outside = F.col("part") != F.col("main")
    # As few blocks of outside members as their number needs.
    outsiders = rows.where(outside).groupBy("band").agg(
        F.ceil(F.count("*") / BLOCK).cast("long").alias("outside_blocks")
    )
    sketched = sketched.join(settle(outsiders), "band")
    own_outside = F.pmod(F.xxhash64("rep"), F.col("outside_blocks"))
    every_outside = F.sequence(F.lit(0).cast("long"), F.col("outside_blocks") - 1)
    held = ["rep", "part", "bands", "fine"]
    here = sketched.select(
        "band", own.alias("i"), F.explode(every_outside).alias("j"), F.lit(False).alias("ask"), *held
    )
    asking = sketched.where(outside).select(
        "band", F.explode(every).alias("i"), own_outside.alias("j"), F.lit(True).alias("ask"), *held
    )

    def close(table):
        ask = table["ask"].to_numpy()
        reps, parts = table["rep"].to_numpy(), table["part"].to_numpy()
        bits = np.frombuffer(b"".join(table["fine"]), np.uint64).reshape(-1, words)
        bands = np.array(table["bands"].tolist(), np.int64).reshape(len(table), -1)
        own_bits, own_reps, own_parts, own_bands = bits[~ask], reps[~ask], parts[~ask], bands[~ask]
        this = int(np.argmax(bands[0] == table["band"].iloc[0]))
        found_a, found_b = [], []
        for x, part, sketch, keys in zip(reps[ask], parts[ask], bits[ask], bands[ask], strict=True):
            odd = np.bitwise_count(own_bits ^ sketch).sum(axis=1, dtype=np.int64)
            first = np.argmax(own_bands == keys, axis=1) == this
            other = own_reps[(odd <= limit) & (own_parts != part) & first]
            found_a.append(np.minimum(other, x))
            found_b.append(np.maximum(other, x))
        empty = np.zeros(0, np.int64)
        pairs = {"a": np.concatenate([empty, *found_a]), "b": np.concatenate([empty, *found_b])}
        return pd.DataFrame(pairs)

    grouped = here.unionByName(asking).groupBy("band", "i", "j")
    return grouped.applyInPandas(close, "a long, b long")


def confirmed(
    pairs: DataFrame, sketches: DataFrame, texts: DataFrame, width: int, percent: int
) -> DataFrame:
    """The pairs (a, b) whose full shingle sets overlap enough."""
    bits = most_odd_bits(percent / 100)

    def near(batches):
        for batch in batches:
            one = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8)
            two = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8)
            odd = np.bitwise_count(one ^ two).reshape(-1, SKETCH_BITS // 8).sum(axis=1)
            yield batch.select([0, 1]).filter(pa.array(odd <= bits))

    def set_row(k, own):
        return (k, own.view(np.int64))

    at_a = sketches.select(F.col("rep").alias("a"), F.col("sketch").alias("sa"))
    at_b = sketches.select(F.col("rep").alias("b"), F.col("sketch").alias("sb"))
    close = settle(
        pairs.join(at_b, "b").join(at_a, "a").select("a", "b", "sa", "sb").mapInArrow(near, "a long, b long")
    )
    ends = close.select(F.explode(F.array("a", "b")).alias("rep"))
    sets = settle(
        _chosen(texts, ends, 2 * close.count())
        .mapInArrow(_with_rows((_SETS, set_row), width), "rep long, items array<long>")
        .where(F.size("items") > 0)
    )
    items_a = sets.select(F.col("rep").alias("a"), F.col("items").alias("ia"))
    items_b = sets.select(F.col("rep").alias("b"), F.col("items").alias("ib"))
    shared = F.size(F.array_intersect("ia", "ib"))
    either = F.size("ia") + F.size("ib") - shared
    return settle(
        close.join(items_b, "b")
        .join(items_a, "a")
        .where(shared * F.lit(100).cast("long") >= either * F.lit(percent))
        .select("a", "b")
    )
