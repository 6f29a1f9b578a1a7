"""Jaccard join of documents by a blocked product of their document by n-gram incidence.

Each distinct set of n-grams is one row of a sparse 0/1 matrix. Columns are ordered from rare to
frequent (by counts over all documents in hashed buckets, then by hash), and of each row only
the beginning matters for finding partners: two rows that are similar enough share a column among
their first n - ceil(limit * n) + 1. The product runs over these columns only, and within a
column over bands of sizes: rows of bands further apart than one cannot be similar.

The rows of a column first meet its smallest one. A pair is discarded if its sizes, its places in
the rows, or the overlap that the two rows can have at all are below what the limit needs; the
last bound is the sum of smaller counts after both rows are folded into a few column blocks.
The others are counted on the full rows. A small column then gives all its pairs of rows that
are not connected yet.

Of a crowded column, only the rows outside the largest component, or outside the rows that
met in an earlier column together, meet the others, in blocks. A block first bounds the overlaps by
the folded rows. If few pairs are left they are counted one by one; if many, the full rows of
the block are multiplied, their overlap counts summed over blocks of columns, and a forest of
the links given out, as only components are wanted. Nothing is left out: the result is exact but for equal 64-bit hashes
of different n-grams.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.settle import settle
from faultline.llm.components import connected
from faultline.llm.neardup import Signer, shingle_sets
from faultline.llm.shipping import send_code

#: Buckets of the column counts: 2 MB in each task, whatever the number of n-grams.
BUCKETS = 1 << 18
#: Columns (within a band of sizes) with more rows than this are crowded.
CROWD = 16
#: Rows and n-grams of a block, and columns of a block, at most about.
BLOCK_ROWS, BLOCK_GRAMS, BLOCK_COLUMNS = 2048, 1 << 21, 4096
#: Two blocks with more possible pairs than so many a row have their full rows multiplied.
DENSE = 4
#: Up to so many document ids (8 MB) are sent to the texts; for more the texts are shuffled.
SENT_IDS = 1_000_000
_PRINTED = pa.schema(
    [("key", pa.int64()), ("n", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()), ("counts", pa.binary())]
)
_SIGNED = pa.schema(
    [
        ("key", pa.int64()),
        ("n", pa.int64()),
        ("p1", pa.int64()),
        ("p2", pa.int64()),
        ("grams", pa.list_(pa.int64())),
        ("folded", pa.binary()),
    ]
)
_SETS = pa.schema(
    [("n", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()), ("items", pa.binary())]
)


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.binary(): "binary", pa.list_(pa.int64()): "array<long>"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _batch(columns, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def prefix_length(n: int, percent: int) -> int:
    """So many first columns of a row hold one of any row that is similar enough."""
    return n - (percent * n + 99) // 100 + 1


def folded(own: np.ndarray) -> bytes:
    """How many n-grams of a row fall into each of a power of two of hash ranges.

    1, 2 or 4 bytes a count, after a byte that says which.
    """
    bits = max(6, math.ceil(math.log2(max(len(own), 8) / 8)))
    place = (own >> np.uint64(64 - bits)).astype(np.int64)
    counts = np.bincount(place, minlength=1 << bits)
    size = 1 if counts.max() < 1 << 8 else 2 if counts.max() < 1 << 16 else 4
    return bytes([size]) + counts.astype(f"<u{size}").tobytes()


def overlap_bound(one: bytes, two: bytes) -> int:
    """At most so many n-grams are in both rows."""
    one, two = (np.frombuffer(x, f"<u{x[0]}", offset=1) for x in (one, two))
    size = min(len(one), len(two))
    one, two = (x.reshape(size, -1).sum(axis=1, dtype=np.int64) for x in (one, two))
    return int(np.minimum(one, two).sum())


def similar(shared, n_a, n_b, percent: int):
    return 100 * shared >= percent * (n_a + n_b - shared)


def _print_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            out = [[], [], [], [], []]
            held, waiting = [], 0
            for key, own in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), width), strict=True):
                for column, value in zip(out, (key, len(own), *Signer.print_of(own), None), strict=True):
                    column.append(value)
                held.append(own & np.uint64(BUCKETS - 1))
                waiting += len(own)
                if waiting > BUCKETS:
                    counts += np.bincount(np.concatenate(held).astype(np.int64), minlength=BUCKETS)
                    held, waiting = [], 0
            if held:
                counts += np.bincount(np.concatenate(held).astype(np.int64), minlength=BUCKETS)
            yield _batch(out, _PRINTED)
        yield _batch([[None], [-1], [0], [0], [zlib.compress(counts.tobytes(), 1)]], _PRINTED)

    return run


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for held in batch.column(0).to_pylist():
            total += np.frombuffer(zlib.decompress(held), np.int64)
    yield pa.RecordBatch.from_pydict({"counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def _column_counts(printed: DataFrame) -> np.ndarray:
    """The BUCKETS counts of all documents, added up in two steps."""
    rows = printed.where("n = -1").select("counts")
    tasks = printed.rdd.getNumPartitions()
    if tasks > 64:
        rows = rows.repartition(int(tasks**0.5)).mapInArrow(_sum_counts, "counts binary")
    row = rows.repartition(1).mapInArrow(_sum_counts, "counts binary").first()
    return np.frombuffer(zlib.decompress(bytes(row["counts"])), np.int64)


def _signed_rows(counts: np.ndarray, width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], [], [], []]
            for key, own in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), width), strict=True):
                if key is None or not len(own):
                    continue
                order = np.lexsort((own, counts[(own & np.uint64(BUCKETS - 1)).astype(np.int64)]))
                grams = own[order[: prefix_length(len(own), percent)]].view(np.int64)
                row = (key, len(own), *Signer.print_of(own), grams, folded(own))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield _batch(out, _SIGNED)

    return run


def _set_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], []]
            for own in shingle_sets(batch.column(0), width):
                for column, value in zip(out, (len(own), *Signer.print_of(own), own.tobytes()), strict=True):
                    column.append(value)
            yield _batch(out, _SETS)

    return run


def _sets(wanted: DataFrame, classes: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """(id, n, items) of the wanted classes, from the texts of their first documents."""
    named = settle(classes.join(wanted, "id", "left_semi").select("id", "rep", "n", "p1", "p2"))
    keys = named.select(F.col("rep").alias("key")).distinct()
    if named.count() <= SENT_IDS:
        keys = F.broadcast(keys)
    texts = rows.join(keys, "key", "left_semi")
    made = texts.select("text").mapInArrow(_set_rows(width), _ddl(_SETS))
    # A repeated document id brings all its texts; the fingerprint says which one is meant.
    return settle(made.join(named, ["n", "p1", "p2"]).select("id", "n", "items").dropDuplicates(["id"]))


def _counted(pairs: DataFrame, classes: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of class ids whose full rows overlap enough."""

    def possible(batches):
        for batch in batches:
            n_a, n_b = (batch.column(i).to_numpy() for i in (2, 3))
            one, two = (batch.column(i).to_pylist() for i in (4, 5))
            most = [overlap_bound(x, y) for x, y in zip(one, two, strict=True)]
            enough = similar(np.array(most, np.int64), n_a, n_b, percent)
            yield batch.select([0, 1]).filter(pa.array(enough, pa.bool_()))

    def exact(batches):
        for batch in batches:
            n_a, n_b = (batch.column(i).to_numpy() for i in (2, 3))
            shared = [
                len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)
            ]
            enough = similar(np.array(shared, np.int64), n_a, n_b, percent)
            yield batch.select([0, 1]).filter(pa.array(enough, pa.bool_()))

    def at(table: DataFrame, end: str, held: str) -> DataFrame:
        return table.select(F.col("id").alias(end), F.col("n").alias(f"n_{end}"), F.col(held).alias(f"h_{end}"))

    def both(pairs: DataFrame, table: DataFrame, held: str) -> DataFrame:
        joined = pairs.join(at(table, "b", held), "b").join(at(table, "a", held), "a")
        return joined.select("a", "b", "n_a", "n_b", "h_a", "h_b")

    left = settle(both(pairs, classes, "folded").mapInArrow(possible, "a long, b long"))
    wanted = left.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = _sets(wanted, classes, rows, width)
    return settle(both(left, sets, "items").mapInArrow(exact, "a long, b long"))


def overlap_counts(sets_a: list[np.ndarray], sets_b: list[np.ndarray]) -> np.ndarray:
    """The product of two blocks of incidence rows, summed over blocks of shared columns."""
    grams_a, grams_b = np.concatenate(sets_a), np.concatenate(sets_b)
    row_a = np.repeat(np.arange(len(sets_a)), [len(s) for s in sets_a])
    row_b = np.repeat(np.arange(len(sets_b)), [len(s) for s in sets_b])
    columns = np.intersect1d(grams_a, grams_b)
    total = np.zeros((len(sets_a), len(sets_b)), np.float32)
    sides = []
    for grams, row in ((grams_a, row_a), (grams_b, row_b)):
        at = np.searchsorted(columns, grams)
        known = at < len(columns)
        known[known] = columns[at[known]] == grams[known]
        order = np.argsort(at[known], kind="stable")
        sides.append((at[known][order], row[known][order]))
    for first in range(0, len(columns), BLOCK_COLUMNS):
        parts = []
        for (at, row), size in zip(sides, (len(sets_a), len(sets_b)), strict=True):
            some = slice(*np.searchsorted(at, (first, first + BLOCK_COLUMNS)))
            dense = np.zeros((size, min(BLOCK_COLUMNS, len(columns) - first)), np.float32)
            dense[row[some], at[some] - first] = 1
            parts.append(dense)
        total += parts[0] @ parts[1].T
    return np.rint(total).astype(np.int64)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """Of links (a, b), as many as connect what they connect."""
    parent: dict[int, int] = {}

    def top(x):
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    kept_a, kept_b = [], []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        one, two = top(x), top(y)
        if one != two:
            parent[max(one, two)] = min(one, two)
            kept_a.append(x)
            kept_b.append(y)
    return kept_a, kept_b


def _block_bounds(percent: int):
    """Pairs (a, b) of two blocks that may be similar; one row without a pair if they are many."""

    def run(table: pd.DataFrame) -> pd.DataFrame:
        asks = table["ask"].to_numpy()
        counts = [np.frombuffer(x, f"<u{x[0]}", offset=1) for x in table["folded"]]
        size = min(len(c) for c in counts)
        counts = np.array([c.reshape(size, -1).sum(axis=1, dtype=np.int32) for c in counts])
        here, there = table[asks], table[~asks]
        own, n, ids, part, met = (there[c].to_numpy() for c in ("own", "n", "id", "part", "met"))
        found_a, found_b, total = [], [], 0
        for place, row in enumerate(here.itertuples()):
            wanted = (own | row.own) & (ids != row.id) & (part != row.part)
            if row.met == row.met and row.met is not None:
                wanted &= met != row.met
            some = np.flatnonzero(wanted)
            most = np.minimum(counts[~asks][some], counts[asks][place]).sum(axis=1) if len(some) else some
            other = ids[some[similar(most, n[some], row.n, percent)]] if len(some) else some
            found_a.append(np.minimum(other, row.id))
            found_b.append(np.maximum(other, row.id))
            total += len(other)
        first = table.iloc[0]
        block = {c: int(first[c]) for c in ("gram", "band", "i", "j")}
        if total > DENSE * len(table):
            return pd.DataFrame([{**block, "a": None, "b": None}]).astype({"a": "Int64", "b": "Int64"})
        none = np.zeros(0, np.int64)
        pairs = pd.DataFrame({"a": np.concatenate([none, *found_a]), "b": np.concatenate([none, *found_b])})
        pairs = pairs.drop_duplicates()
        return pairs.assign(**block)[["gram", "band", "i", "j", "a", "b"]].astype({"a": "Int64", "b": "Int64"})

    return run


def _block_product(percent: int):
    def run(table: pd.DataFrame) -> pd.DataFrame:
        asks = table["ask"].to_numpy()
        none = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        if asks.all() or not asks.any():
            return none
        here, there = table[asks], table[~asks]
        counts = overlap_counts(*[[np.frombuffer(i, np.uint64) for i in t["items"]] for t in (here, there)])

        def column(name):
            return here[name].to_numpy()[:, None], there[name].to_numpy()[None, :]

        own_x, own_y = column("own")
        n_x, n_y = column("n")
        id_x, id_y = column("id")
        part_x, part_y = column("part")
        wanted = similar(counts, n_x, n_y, percent) & (own_x | own_y) & (id_x != id_y) & (part_x != part_y)
        x, y = np.nonzero(wanted)
        a, b = forest(id_x[x, 0], id_y[0, y])
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return run


def _crowds(members: DataFrame, grouped: DataFrame) -> DataFrame:
    """(gram, band, id, n, own, part, outside) of crowded columns that are not yet one component."""
    rows = members.join(grouped.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "part", F.coalesce("component", "id")
    )
    # Rows with a common earlier crowded column have met there.
    first = rows.groupBy("id", "band").agg(F.min(F.struct("pos", "gram")).alias("first"))
    rows = settle(
        rows.join(first, ["id", "band"]).select(
            "gram",
            "band",
            "id",
            "n",
            "own",
            "part",
            F.when(F.col("first.pos") < F.col("pos"), F.col("first.gram")).alias("met"),
        )
    )

    def largest(label: str) -> DataFrame:
        held = rows.where(F.col(label).isNotNull()).groupBy("gram", "band", label).agg(F.count("*").alias("held"))
        return held.groupBy("gram", "band").agg(
            F.max(F.struct("held", label)).alias(f"most_{label}"), F.count("*").alias(f"kinds_{label}")
        )

    def outside_of(label: str) -> Column:
        return F.coalesce(F.col(label) != F.col(f"most_{label}")[label], F.lit(True))

    judged = rows.join(largest("part"), ["gram", "band"]).where("kinds_part > 1")
    judged = judged.join(largest("met"), ["gram", "band"], "left")
    by_met = F.coalesce(F.col("most_met.held") >= F.col("most_part.held"), F.lit(False))
    outside = F.when(by_met, outside_of("met")).otherwise(outside_of("part"))
    return settle(judged.select("gram", "band", "id", "n", "own", "part", "met", outside.alias("outside")))


def _crowd_links(
    open_rows: DataFrame, tried: DataFrame, classes: DataFrame, rows: DataFrame, width: int, percent: int
) -> DataFrame:
    """Links (a, b) between rows outside and all rows of each crowded column."""

    def blocks(which: DataFrame, name: str) -> DataFrame:
        need = F.greatest(F.count("*") / BLOCK_ROWS, F.sum("n") / BLOCK_GRAMS)
        return which.groupBy("gram", "band").agg(F.ceil(need).cast("long").alias(name))

    sizes = blocks(open_rows, "all_blocks").join(
        blocks(open_rows.where("outside"), "ask_blocks"), ["gram", "band"]
    )
    ready = open_rows.join(settle(sizes), ["gram", "band"])
    spread = F.xxhash64("id")

    def every(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))

    keep = ["gram", "band", "id", "n", "own", "part", "met"]
    here = ready.select(
        *keep, F.pmod(spread, F.col("all_blocks")).alias("i"), every("ask_blocks").alias("j"), F.lit(False).alias("ask")
    )
    asking = ready.where("outside").select(
        *keep, every("all_blocks").alias("i"), F.pmod(spread, F.col("ask_blocks")).alias("j"), F.lit(True).alias("ask")
    )
    dealt = here.unionByName(asking)
    bounded = settle(
        dealt.join(classes.select("id", "folded"), "id")
        .groupBy("gram", "band", "i", "j")
        .applyInPandas(_block_bounds(percent), "gram long, band long, i long, j long, a long, b long")
    )
    few = bounded.where("a IS NOT NULL").select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
    links = _counted(settle(few), classes, rows, width, percent)
    dense = bounded.where("a IS NULL").select("gram", "band", "i", "j")
    if dense.isEmpty():
        return links
    # Blocks of rows that are much alike: their full rows are multiplied, links leave as a forest.
    many = settle(dealt.join(dense, ["gram", "band", "i", "j"]))
    sets = _sets(many.select("id").distinct(), classes, rows, width).select("id", "items")
    product = many.join(sets, "id").groupBy("gram", "band", "i", "j")
    return links.union(settle(product.applyInPandas(_block_product(percent), "a long, b long")))


def jaccard_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    width: int = 3,
    percent: int = 90,
) -> DataFrame:
    """(key, n_shingles, component_id) of every row.

    Documents are linked when 100 * shared n-grams >= percent * all their n-grams; component_id
    is the smallest key that a chain of links reaches. The words are the runs without ASCII white
    space, A-Z in lower case. Fewer words than `width` are one n-gram; a text without words, or
    null, has none, is linked with nothing and names itself. Rows that repeat a key are one document and
    join what they are linked with; all are returned. A row with a null key is returned with a
    null component and links nothing. Other columns are not read. Whole texts are compared;
    an empty table gives an empty result.
    """
    send_code(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    printed = settle(rows.mapInArrow(_print_rows(width), _ddl(_PRINTED)))
    counts = _column_counts(printed)
    prints = printed.where("n >= 0").select("key", "n", "p1", "p2")
    signed = rows.mapInArrow(_signed_rows(counts, width, percent), _ddl(_SIGNED))
    classes = settle(
        signed.groupBy("p1", "p2", "n").agg(
            F.min("key").alias("rep"), F.first("grams").alias("grams"), F.first("folded").alias("folded")
        )
    ).withColumn("id", F.monotonically_increasing_id())
    links = _links(classes, rows, width, percent)
    in_class = prints.where("n > 0 AND key IS NOT NULL").join(
        classes.select("p1", "p2", "n", "id"), ["p1", "p2", "n"]
    )
    same_key = in_class.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b")
    if not same_key.isEmpty():
        some = in_class.join(same_key.select("key", "a"), "key").where("id <> a")
        links = links.union(some.select("a", F.col("id").alias("b")))
    grouped = connected(links)
    labelled = classes.join(grouped, classes["id"] == grouped["node"], "left").select(
        "p1", "p2", "n", "rep", F.coalesce("component", "id").alias("part")
    )
    names = labelled.groupBy("part").agg(F.min("rep").alias("component_id"))
    named = settle(labelled.join(names, "part").select("p1", "p2", "n", "component_id"))
    found = prints.join(named, ["p1", "p2", "n"], "left")
    return found.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNotNull(), F.coalesce("component_id", "key")).alias("component_id"),
    )


def _links(classes: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) of class ids that connect whatever all links connect."""
    postings = classes.select("id", "n", F.posexplode("grams").alias("pos", "gram"))
    shared = postings.groupBy("gram").agg(F.count("*").alias("rows")).where("rows > 1").select("gram")
    step = math.log(100 / percent) * (1 + 1e-6) if percent < 100 else 1.0
    band = F.floor(F.log("n") / F.lit(step)).cast("long")
    both = F.array(
        F.struct(band.alias("band"), F.lit(True).alias("own")),
        F.struct((band + 1).alias("band"), F.lit(False).alias("own")),
    )
    postings = settle(postings.join(shared, "gram"))
    members = postings.select("gram", "id", "n", "pos", F.inline(both))
    mine = F.when(F.col("own"), F.struct("id", "n", "pos"))
    columns = (
        members.groupBy("gram", "band")
        .agg(F.count("*").alias("rows"), F.count_if(F.col("own")).alias("owners"), F.min(mine).alias("low"))
        .where("rows > 1 AND owners > 0")
        .select("gram", "band", (F.col("rows") > CROWD).alias("crowded"), "low")
    )
    members = settle(members.join(columns, ["gram", "band"]))

    def possible(n_a, pos_a, n_b, pos_b) -> Column:
        # Columns before the shared one, itself, and those after it.
        most = F.least(pos_a, pos_b) + 1 + F.least(n_a - pos_a, n_b - pos_b) - 1
        return F.lit(100) * most >= F.lit(percent) * (n_a + n_b - most)

    def ordered(x: Column, y: Column) -> list[Column]:
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    # Every row meets the smallest of its column; what that connects is not compared again.
    to_low = (
        members.where(F.col("id") != F.col("low.id"))
        .where(possible(F.col("n"), F.col("pos"), F.col("low.n"), F.col("low.pos")))
        .select(*ordered(F.col("id"), F.col("low.id")))
    )
    tried = settle(to_low.distinct())
    links = _counted(tried, classes, rows, width, percent)
    grouped = settle(connected(links))
    small = members.where("NOT crowded").join(grouped.withColumnRenamed("node", "id"), "id", "left")
    small = small.withColumn("part", F.coalesce("component", "id"))
    held = ("id", "n", "pos", "part")
    one = small.where("own").select("gram", "band", *[F.col(c).alias(f"{c}_x") for c in held])
    two = small.select("gram", "band", "own", *[F.col(c).alias(f"{c}_y") for c in held])
    pairs = (
        one.join(two, ["gram", "band"])
        .where("part_x <> part_y AND (NOT own OR id_x < id_y)")
        .where(possible(F.col("n_x"), F.col("pos_x"), F.col("n_y"), F.col("pos_y")))
        .select(*ordered(F.col("id_x"), F.col("id_y")))
        .distinct()
        .join(tried, ["a", "b"], "left_anti")
    )
    links = links.union(_counted(settle(pairs), classes, rows, width, percent))
    crowded = members.where("crowded").drop("low", "crowded")
    if crowded.isEmpty():
        return links
    open_rows = _crowds(crowded, grouped)
    return links.union(_crowd_links(open_rows, tried, classes, rows, width, percent))
