"""Cheapest repair of conversation structure through a suffix-shared word graph.

A row is one letter: its role initial if that is s, u or a, else o; in upper case if the text is
cut off, and x if the row has to go (blank, or seen before). The letters of a conversation are
its signature, cut from the end into pieces of at most PIECE letters. Equal pieces of all
conversations are one word, and words with a common end share the nodes of that end: the words
are sorted from their last letter, so a node is made once and reused by all words that follow.
A node holds, for every grammar state that it is entered in and every one it is left in, the
smallest cost and the ASCII-least edits of that cost.

The grammar is (s?(ua)+)?: state 0 nothing yet, 1 after s, 2 after u, 3 after a. Edits that end
with the edit of a row are never a beginning of other edits of the same rows, so the least edits
of two pieces are those of the one followed by those of the other, and a piece may choose by its
own edits alone once the costs to go after it are known. A conversation of many pieces gets
these costs by matrix products over blocks of FAN pieces, then blocks of blocks; the entry
states come back the same way. No task sees more than FAN pieces of a conversation at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.settle import settle
from faultline.llm.shipping import send_code

PIECE = 32
FAN = 256
#: A word that at least this share of all pieces have is sent to all tasks: at most 1000 words.
HOT = 1000
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
NEVER = 1 << 60
_AFTER_INSERT = (2, 2, 3, 2)
#: Costs and edits that end a conversation, by state.
END = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))


def row_edits(letter: str) -> list[list[tuple[int, str] | None]]:
    """The least (cost, edits) of one row with inserts before it: [state before][state after]."""
    found: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in range(4)]

    def offer(before, after, cost, edits):
        old = found[before][after]
        if old is None or (cost, edits) < old:
            found[before][after] = (cost, edits)

    extra = CUT_OFF if letter.isupper() else 0
    for before in range(4):
        state, paid, edits = before, 0, ""
        for _ in range(3):
            offer(before, state, paid + DELETE, edits + "D")
            if letter != "x":
                role = "a" if state == 2 else "u"
                after = _AFTER_INSERT[state]
                offer(before, after, paid + extra + REROLE, edits + "R")
                if letter.lower() == role:
                    offer(before, after, paid + extra + KEEP, edits + "K")
                if letter.lower() == "s" and state == 0:
                    offer(before, 1, paid + extra + KEEP, edits + "K")
            state, paid, edits = _AFTER_INSERT[state], paid + INSERT, edits + "I"
    return found


_EMPTY = [[(0, "") if p == q else None for q in range(4)] for p in range(4)]


def before_suffix(edits, suffix):
    """The node of one more letter in front of a suffix's node."""
    out = []
    for p in range(4):
        row = [None] * 4
        for step, ends in zip(edits[p], suffix, strict=True):
            if step is None:
                continue
            for q, rest in enumerate(ends):
                if rest is not None:
                    whole = (step[0] + rest[0], step[1] + rest[1])
                    if row[q] is None or whole < row[q]:
                        row[q] = whole
        out.append(row)
    return out


_NODES = pa.schema(
    [("word", pa.string()), ("costs", pa.list_(pa.int64())), ("edits", pa.list_(pa.string()))]
)


def word_graph(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words sorted by their reverse to the values of their nodes; shared ends are made once."""
    letters = {c: row_edits(c) for c in "xsuaoSUAO"}
    path, end = [_EMPTY], ""
    for batch in batches:
        words, costs, edits = [], [], []
        for word in batch.column(0).to_pylist():
            back = word[::-1]
            shared = 0
            while shared < min(len(end), len(back)) and end[shared] == back[shared]:
                shared += 1
            del path[shared + 1 :]
            for letter in back[shared:]:
                path.append(before_suffix(letters[letter], path[-1]))
            end = back
            flat = [cell for row in path[-1] for cell in row]
            words.append(word)
            costs.append([NEVER if c is None else c[0] for c in flat])
            edits.append(["" if c is None else c[1] for c in flat])
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(costs, _NODES.field(1).type), pa.array(edits, _NODES.field(2).type)],
            schema=_NODES,
        )


def choose(costs: list[int], edits: list[str], togo: list[int], state: int) -> int:
    """The state after a piece entered in `state`, given the costs to go after it."""
    return min(
        (costs[4 * state + q] + togo[q], edits[4 * state + q], q)
        for q in range(4)
        if costs[4 * state + q] < NEVER
    )[2]


def _conversation(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, turn, role, text) with the faults that crc32(`conv:turn`) % 20 names.

    0 drops the row, 1 empties its text, 2 takes `.!?` out of it, 3 repeats it, 4 makes the user its
    role. Null roles and texts become one space, as do null parts of the hashed key.
    """
    written = F.concat(_conversation(conv), F.lit(":"), _conversation(turn))
    kept = rows.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        (F.crc32(written.cast("binary")) % 20).alias("fault"),
    ).where("fault <> 0")
    fault = F.col("fault")
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    changed = F.when(fault == 1, F.lit("")).when(fault == 2, F.translate("text", ".!?", ""))
    return kept.select(
        "conv_id",
        "turn",
        F.when(fault == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        changed.otherwise(F.col("text")).alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _positions(slim: DataFrame) -> DataFrame:
    """The rows with `from_end`, the number of rows after each in its conversation.

    The rows are range-sorted, so a long conversation lies in several partitions. What other
    partitions hold is added to the few conversations that cross a limit, two per partition.
    """
    order = ["conv", F.col("turn").asc_nulls_first(), "key", "rid"]
    ordered = slim.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = settle(ordered).withColumn("at", F.monotonically_increasing_id())
    placed = placed.withColumn("part", F.shiftright("at", 33))
    runs = placed.groupBy("conv", "part").agg(F.count("*").alias("held"))
    crossing = Window.partitionBy("conv")
    later = crossing.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    spans = settle(
        runs.withColumn("parts", F.count("*").over(crossing))
        .where("parts > 1")
        .select("conv", "part", F.coalesce(F.sum("held").over(later), F.lit(0)).alias("beyond"))
    )
    inside = Window.partitionBy("conv", "part").orderBy(F.desc("at"))
    return (
        placed.withColumn("place", F.row_number().over(inside) - 1)
        .join(F.broadcast(spans), ["conv", "part"], "left")
        .withColumn("from_end", F.col("place") + F.coalesce("beyond", F.lit(0)))
        .drop("place", "beyond", "part", "at")
    )


def _blocks_of(rows: DataFrame) -> DataFrame:
    return rows.withColumn("block", F.floor(F.col("piece") / FAN).cast("long"))


def _costs_to_go(pieces: DataFrame) -> DataFrame:
    """(conv, piece, togo) from (conv, piece, costs); piece 0 is the last of a conversation."""
    most = pieces.agg(F.max("piece")).first()[0] or 0
    if most == 0:
        end = F.array(*[F.lit(cost).cast("long") for cost, _ in END])
        return pieces.select("conv", "piece", end.alias("togo"))

    def product(table):
        table = table.sort_values("piece")
        whole = None
        for costs in table["costs"]:  # from the end to the start
            one = np.array(costs, np.int64).reshape(4, 4)
            whole = one if whole is None else np.minimum((one[:, :, None] + whole[None]).min(axis=1), NEVER)
        return pd.DataFrame(
            {"conv": [table["conv"].iloc[0]], "piece": [table["block"].iloc[0]], "costs": [whole.ravel().tolist()]}
        )

    blocks = settle(
        _blocks_of(pieces).groupBy("conv", "block").applyInPandas(product, "conv string, piece long, costs array<long>")
    )
    above = _costs_to_go(blocks).withColumnRenamed("piece", "block")

    def spread(table):
        table = table.sort_values("piece")
        togo = np.array(table["togo"].iloc[0], np.int64)
        found = []
        for costs in table["costs"]:
            found.append(togo.tolist())
            togo = (np.array(costs, np.int64).reshape(4, 4) + togo).min(axis=1)
        return pd.DataFrame({"conv": table["conv"], "piece": table["piece"], "togo": found})

    return settle(
        _blocks_of(pieces)
        .join(above, ["conv", "block"])
        .groupBy("conv", "block")
        .applyInPandas(spread, "conv string, piece long, togo array<long>")
    )


def _entry_states(pieces: DataFrame) -> DataFrame:
    """(conv, piece, state) from (conv, piece, next): the state after a piece by the one before."""
    most = pieces.agg(F.max("piece")).first()[0] or 0
    if most == 0:
        return pieces.select("conv", "piece", F.lit(0).cast("long").alias("state"))

    def compose(table):
        whole = np.arange(4)
        for following in table.sort_values("piece", ascending=False)["next"]:
            whole = np.array(following, np.int64)[whole]
        return pd.DataFrame(
            {"conv": [table["conv"].iloc[0]], "piece": [table["block"].iloc[0]], "next": [whole.tolist()]}
        )

    blocks = settle(
        _blocks_of(pieces).groupBy("conv", "block").applyInPandas(compose, "conv string, piece long, next array<long>")
    )
    above = _entry_states(blocks).withColumnRenamed("piece", "block")

    def spread(table):
        table = table.sort_values("piece", ascending=False)
        state = int(table["state"].iloc[0])
        found = []
        for following in table["next"]:
            found.append(state)
            state = int(following[state])
        return pd.DataFrame({"conv": table["conv"], "piece": table["piece"], "state": found})

    return settle(
        _blocks_of(pieces)
        .join(above, ["conv", "block"])
        .groupBy("conv", "block")
        .applyInPandas(spread, "conv string, piece long, state long")
    )


def _next_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = batch.to_pydict()
        following = [
            [choose(c, e, t, p) for p in range(4)]
            for c, e, t in zip(table["costs"], table["edits"], table["togo"], strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(following, pa.list_(pa.int64()))],
            names=["conv", "piece", "next"],
        )


_EDITED = pa.schema(
    [
        ("conv", pa.string()),
        ("piece", pa.int64()),
        ("cost", pa.int64()),
        ("audit", pa.string()),
        (
            "turns",
            pa.list_(pa.struct([("place", pa.int64()), ("key", pa.binary()), ("role", pa.string())])),
        ),
    ]
)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each piece, and the turns that stay or are put in, in their order.

    A place is -4 * the rows from its row to the end, and a number below 4 for the order there.
    """
    names = ("user", "assistant")
    for batch in batches:
        out = [[], [], [], [], []]
        for row in batch.to_pylist():
            state, piece = row["state"], row["piece"]
            after = choose(row["costs"], row["edits"], row["togo"], state)
            cost, audit = row["costs"][4 * state + after], row["edits"][4 * state + after]
            if piece == 0:
                cost, audit = cost + END[after][0], audit + END[after][1]
            turns, at = [], 0
            place = lambda: -4 * (piece * PIECE + len(row["word"]) - at)  # noqa: B023, E731
            inserted = 0
            for edit in audit:
                if edit == "I":
                    turns.append({"place": place() + inserted, "key": None, "role": names[state == 2]})
                    state, inserted = _AFTER_INSERT[state], inserted + 1
                    continue
                if edit != "D":
                    role = names[state == 2] if edit == "R" else None
                    turns.append({"place": place() + 3, "key": row["keys"][at], "role": role})
                    first = edit == "K" and row["word"][at] in "sS"
                    state = 1 if first else _AFTER_INSERT[state]
                at, inserted = at + 1, 0
            for kept, value in zip(out, (row["conv"], piece, cost, audit, turns), strict=True):
                kept.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(out, _EDITED, strict=True)], schema=_EDITED
        )


def repair(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(report, turns): the faults and cheapest edits of each conversation, and what it becomes.

    report: conversation id, gaps, blank, duplicate, truncated, illegal, cost (long), audit;
    turns: conversation id, place, role, text of the repaired conversation, ordered by place.
    A conversation is read by turn, nulls first; rows with the same turn come in the order of
    md5(length of role, role, text), equal rows together. Null roles and texts count as one
    space. Rows with a null id are a conversation of their own (of string ids, together with
    the id of one space). Blank texts, and rows whose role and text an earlier row of the
    conversation has, are deleted; the result does not depend on which of two equal rows comes
    first. Whole texts are read whatever their length. An empty table gives empty results.
    Other columns are not read.
    """
    send_code(rows.sparkSession)
    whole = rows.select(
        F.col(conv).alias("id"),
        _conversation(conv).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    stamp = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    whole = whole.withColumn("key", stamp)
    ended = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.left("role", F.lit(1))
    slim = settle(
        whole.select(
            "conv",
            "turn",
            "key",
            F.monotonically_increasing_id().alias("rid"),
            F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o")).alias("letter"),
            (ended == "").alias("blank"),
            (~F.right(ended, F.lit(1)).isin(".", "!", "?")).alias("cut_off"),
        )
    )
    in_order = F.struct(F.col("turn").isNotNull(), "turn", "rid")
    firsts = slim.groupBy("conv", "key").agg(F.min(in_order)["rid"].alias("rid")).select("rid")
    marked = slim.join(firsts.withColumn("first", F.lit(True)), "rid", "left")
    fault = (
        F.when(F.col("blank"), "b").when(F.col("first").isNull(), "d").when(F.col("cut_off"), "t").otherwise("k")
    )
    marked = settle(
        _positions(
            marked.select("conv", "turn", "key", "rid", "letter", fault.alias("fault"))
        ).withColumn(
            "sign",
            F.when(F.col("fault").isin("b", "d"), "x")
            .when(F.col("fault") == "t", F.upper("letter"))
            .otherwise(F.col("letter")),
        )
    )

    counts = (
        marked.groupBy("conv", "turn")
        .agg(*[F.count_if(F.col("fault") == f).alias(f) for f in "bdt"])
        .groupBy("conv")
        .agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
            F.sum("b").alias("blank"),
            F.sum("d").alias("duplicate"),
            F.sum("t").alias("truncated"),
        )
    )
    # The last row of a piece is also shown to the piece after it, for the pair of their roles.
    own = F.floor(F.col("from_end") / PIECE).cast("long")
    shown = F.when(
        (F.col("from_end") % PIECE == 0) & (own > 0), F.array(own, own - 1)
    ).otherwise(F.array(own))
    dealt = marked.withColumn("piece", F.explode(shown))
    packed = F.sort_array(
        F.collect_list(F.struct((-F.col("from_end")).alias("order"), "sign", "letter", "key"))
    )
    pieces = dealt.groupBy("conv", "piece").agg(packed.alias("rows"))
    inner = F.filter("rows", lambda r: -r["order"] < (F.col("piece") + 1) * PIECE)
    initials = F.concat_ws("", F.transform("rows", lambda r: r["letter"]))
    pairs = F.transform(
        F.sequence(F.lit(1), F.size("rows") - 1), lambda i: F.substring(initials, i, F.lit(2))
    )
    illegal = F.when(F.size("rows") > 1, F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au"))))
    pieces = settle(
        pieces.select(
            "conv",
            "piece",
            F.concat_ws("", F.transform(inner, lambda r: r["sign"])).alias("word"),
            F.transform(inner, lambda r: r["key"]).alias("keys"),
            F.coalesce(illegal, F.lit(0)).cast("long").alias("illegal"),
        )
    )

    words = settle(pieces.groupBy("word").agg(F.count("*").alias("pieces")))
    total = words.agg(F.sum("pieces")).first()[0] or 0
    backwards = F.reverse("word")
    sorted_words = words.select("word").repartitionByRange(backwards).sortWithinPartitions(backwards)
    nodes = settle(
        sorted_words.mapInArrow(word_graph, "word string, costs array<long>, edits array<string>")
    )
    hot = words.where(F.col("pieces") * HOT >= total).select("word")
    hot_nodes = F.broadcast(nodes.join(F.broadcast(hot), "word", "left_semi"))
    common = pieces.join(hot_nodes, "word")
    rare = pieces.join(F.broadcast(hot), "word", "left_anti").join(nodes, "word")
    valued = settle(
        common.select("conv", "piece", "word", "keys", "illegal", "costs", "edits").union(
            rare.select("conv", "piece", "word", "keys", "illegal", "costs", "edits")
        )
    )
    # Only conversations of several pieces need costs and states from each other.
    long = valued.where("piece > 0").select("conv").distinct()
    in_long = settle(valued.join(long, "conv", "left_semi").select("conv", "piece", "costs", "edits"))
    togo = _costs_to_go(in_long.select("conv", "piece", "costs"))
    following = settle(
        in_long.join(togo, ["conv", "piece"])
        .select("conv", "piece", "costs", "edits", "togo")
        .mapInArrow(_next_states, "conv string, piece long, next array<long>")
    )
    states = _entry_states(following)
    known = togo.join(states, ["conv", "piece"])
    end = F.array(*[F.lit(cost).cast("long") for cost, _ in END])
    ready = valued.join(known, ["conv", "piece"], "left").select(
        "conv",
        "piece",
        "word",
        "keys",
        "costs",
        "edits",
        F.coalesce("togo", end).alias("togo"),
        F.coalesce("state", F.lit(0).cast("long")).alias("state"),
    )
    edited = settle(
        ready.mapInArrow(
            _edited,
            "conv string, piece long, cost long, audit string,"
            " turns array<struct<place: long, key: binary, role: string>>",
        )
    )
    in_turn = F.sort_array(F.collect_list(F.struct((-F.col("piece")).alias("order"), "audit")))
    audits = edited.groupBy("conv").agg(
        F.sum("cost").alias("cost"),
        F.concat_ws("", F.transform(in_turn, lambda a: a["audit"])).alias("audit"),
    )
    pairs_of = pieces.groupBy("conv").agg(F.sum("illegal").alias("illegal"))
    ids = whole.select("id", "conv").distinct()
    report = (
        ids.join(counts, "conv")
        .join(pairs_of, "conv")
        .join(audits, "conv")
        .select(
            F.col("id").alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
        )
    )

    left = edited.select("conv", F.inline("turns"))
    texts = whole.select("conv", "key", F.col("role").alias("own"), "text").dropDuplicates(["conv", "key"])
    stay = left.where("key IS NOT NULL").join(texts, ["conv", "key"])
    put_in = left.where("key IS NULL")
    turns = stay.select("conv", "place", F.coalesce("role", "own").alias("role"), "text").union(
        put_in.select("conv", "place", "role", F.lit(""))
    )
    return report, turns


def digests(turns: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): sha256 of the newline-joined `role:text` of repaired turns.

    A digest runs over its conversation in order, so the turns of one conversation pass through
    one task; they stream by, and the task holds one batch of them.
    """

    def run(batches):
        now, state = None, None
        for batch in batches:
            convs, found = [], []
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if conv == now:
                    state.update(b"\n")
                else:
                    if now is not None:
                        convs.append(now)
                        found.append(state.hexdigest())
                    now, state = conv, hashlib.sha256()
                state.update(line.encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([pa.array(convs, pa.string()), pa.array(found, pa.string())], names=["conv", "repaired_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_pydict({"conv": [now], "repaired_sha256": [state.hexdigest()]})

    lines = turns.select("conv", "place", F.concat_ws(":", "role", "text").alias("line"))
    ordered = lines.repartition("conv").sortWithinPartitions("conv", "place")
    return ordered.select("conv", "line").mapInArrow(run, "conv string, repaired_sha256 string")


def repaired_report(rows: DataFrame, *, damage: bool = True) -> DataFrame:
    """One row per conversation: the report of repair() and the digest of the repaired turns.

    A conversation that loses all its rows to the damage has zeros, no edits and an empty digest.
    """
    report, turns = repair(damaged(rows) if damage else rows)
    ids = rows.select("conv_id").distinct().withColumn("conv", _conversation("conv_id"))
    found = report.withColumn("conv", _conversation("conv_id")).drop("conv_id")
    joined = ids.join(found, "conv", "left").join(digests(turns), "conv", "left")
    zeros = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in zeros],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
