"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram is bound by multiplying its
letters' vectors, each rotated by its place; a text is the bundle (sum) of the
vectors of all its n-grams, a language the bundle of its training texts. A text gets
the language whose prototype has the largest cosine with it.

Letters are compared in lower case; what lies between words counts as one gap, so
n-grams also tell how words begin and end. Nothing but the text is used to predict.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faultline.llm.shipping import send_code
from faultline.llm.text import mix

DIMENSIONS = 1024
N = 3
BLOCK_CHARS = 300_000
#: Training rows per language, at most about; smaller languages are used whole.
TRAIN_ROWS = 8_000
UNKNOWN = "und"
#: Cosines that texts without a common trigram stay below: four deviations of their noise.
NOISE = 4 / DIMENSIONS**0.5


def letter_vectors(codes: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """One vector of +1 and -1 per code point, the same in every task."""
    words = np.arange(dimensions // 64, dtype=np.uint64)
    base = np.uint64(seed * 0xD1342543DE82EF95 % (1 << 64))
    keys = codes.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + words * np.uint64(
        0xC2B2AE3D27D4EB4F
    )
    bits = np.unpackbits(mix(keys + base).view(np.uint8), axis=1)
    return (bits.astype(np.int8) << 1) - 1


def _grams(texts: list[str], n: int):
    """(text index, n-gram row) of every n-gram, n-grams as rows of letter numbers, letters.

    Letter 0 is the gap. Windows of gaps only do not exist, as a gap is one place.
    """
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    seen = np.zeros(0x110000, dtype=bool)
    seen[codes] = True
    present = np.flatnonzero(seen)
    letters = np.array([c for c in present.tolist() if chr(c).isalpha()], dtype=np.int64)
    number = np.zeros(0x110000, dtype=np.int32)
    number[letters] = np.arange(1, len(letters) + 1)
    cells = number[codes]
    inside = cells > 0
    # A gap stands before the first letter of each word and after the last word.
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | (owner[1:] != owner[:-1])
    places = np.cumsum(inside) - 1 + np.cumsum(starts)
    size = int(inside.sum() + starts.sum())
    line = np.zeros(size, dtype=np.int32)
    line[places[inside]] = cells[inside]
    whose = np.zeros(size, dtype=np.int64)
    whose[places[inside]] = owner[inside]
    whose[places[starts] - 1] = owner[starts]
    base = len(letters) + 1
    # Close the last word of each text with a gap: windows that run over the end of a text
    # read zeros there.
    total = len(line)
    gram = np.zeros(total, dtype=np.int64)
    fits = np.ones(total, dtype=bool)
    for step in range(n):
        shifted = np.zeros(total, dtype=np.int64)
        shifted[: total - step] = line[step:]
        same = np.zeros(total, dtype=bool)
        same[: total - step] = whose[step:] == whose[: total - step]
        shifted[~same] = 0
        if 0 < step < n - 1:
            fits &= same
        gram = gram * base + shifted
    gram, whose = gram[fits], whose[fits]
    space = base**n
    if space <= 1 << 22:
        used = np.zeros(space, dtype=bool)
        used[gram] = True
        kinds = np.flatnonzero(used)
        row = np.zeros(space, dtype=np.int32)
        row[kinds] = np.arange(len(kinds))
        rows = row[gram]
    else:
        kinds, rows = np.unique(gram, return_inverse=True)
    spelled = np.stack([(kinds // base ** (n - 1 - i)) % base for i in range(n)], axis=1)
    return whose, rows, spelled, letters


def bundle(texts: list[str], n: int, dimensions: int, seed: int) -> np.ndarray:
    """The hypervector of each text; zeros for a text without a letter."""
    whose, rows, spelled, letters = _grams(texts, n)
    if not len(rows):
        return np.zeros((len(texts), dimensions), np.float32)
    table = letter_vectors(np.concatenate([[0], letters]), dimensions, seed)
    bound = reduce(
        np.multiply, (np.roll(table, n - 1 - i, axis=1)[spelled[:, i]] for i in range(n))
    )
    counts = np.bincount(
        whose * len(spelled) + rows, minlength=len(texts) * len(spelled)
    ).reshape(len(texts), len(spelled))
    return counts.astype(np.float32) @ bound.astype(np.float32)


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about BLOCK_CHARS letters together, at most 64."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        if held and (size + len(text or "") > BLOCK_CHARS or len(held) == 64):
            yield first, held
            first, held, size = i, [], 0
        held.append(text or "")
        size += len(held[-1])
    if held:
        yield first, held


def train(
    rows: DataFrame,
    text: str = "text",
    lang: str = "lang",
    *,
    train_rows: int = TRAIN_ROWS,
    sample_key: str | None = None,
    n: int = N,
    dimensions: int = DIMENSIONS,
    seed: int = 7,
) -> pd.DataFrame:
    """(lang, vector) prototypes from rows with a label and a text.

    With `sample_key`, a language with more than `train_rows` rows is fitted on a hash sample
    of about that many; without it, on all. The model has one vector per language.
    """
    send_code(rows.sparkSession)
    labelled = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"),
        F.col(text).alias("text"),
        (F.col(sample_key) if sample_key else F.lit(0)).cast("string").alias("key"),
    )
    if sample_key:
        counts = labelled.groupBy("lang").count()
        share = F.lit(float(train_rows)) / F.col("count")
        draw = F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(1 << 30)) / float(1 << 30)
        # One row per language, as the model itself has.
        labelled = labelled.join(F.broadcast(counts), "lang").where(draw < share)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for first, held in _blocks(batch.column(1).to_pylist()):
                vectors = bundle(held, n, dimensions, seed)
                # Texts weigh alike, long or short.
                norms = np.linalg.norm(vectors, axis=1, keepdims=True)
                vectors = np.divide(vectors, norms, where=norms > 0, out=np.zeros_like(vectors))
                for i, vector in enumerate(vectors):
                    own = langs[first + i]
                    sums[own] = sums.get(own, 0) + vector.astype(np.float64)
        yield pa.RecordBatch.from_pydict(
            {"lang": list(sums), "vector": [v.tolist() for v in sums.values()]},
            schema=pa.schema([("lang", pa.string()), ("vector", pa.list_(pa.float64()))]),
        )

    parts = labelled.select("lang", "text").mapInArrow(partial, "lang string, vector array<double>")
    summed = (
        parts.select("lang", F.posexplode("vector").alias("i", "x"))
        .groupBy("lang", "i")
        .agg(F.sum("x").alias("x"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("cells"))
        .select("lang", F.col("cells.x").alias("vector"))
    )
    # One row of `dimensions` numbers per language.
    return summed.orderBy("lang").toPandas()


def predict(
    docs: DataFrame,
    model: pd.DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    n: int = N,
    dimensions: int = DIMENSIONS,
    seed: int = 7,
    whole_rows: bool = False,
) -> DataFrame:
    """(key, lang_pred, score [, row]): the nearest language of every whole text, and its cosine.

    A null text, a text without a letter, and any text under an empty model is `und` with
    score 0. The score is the cosine cut to 0..1; equal cosines go to the language that
    sorts first. Repeated rows are predicted one by one; other columns are not read unless
    `whole_rows` asks for them as the struct `row`.
    """
    send_code(docs.sparkSession)
    langs = model["lang"].tolist()
    prototypes = np.array(model["vector"].tolist(), dtype=np.float64).reshape(-1, dimensions)
    norms = np.linalg.norm(prototypes, axis=1, keepdims=True)
    prototypes = np.divide(prototypes, norms, where=norms > 0, out=np.zeros_like(prototypes))
    compared = prototypes.T.astype(np.float32)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[str] = []
            scores: list[float] = []
            for _, held in _blocks(batch.column(1).to_pylist()):
                vectors = bundle(held, n, dimensions, seed)
                sizes = np.linalg.norm(vectors, axis=1)
                if not langs:
                    found += [UNKNOWN] * len(held)
                    scores += [0.0] * len(held)
                    continue
                cosines = (vectors @ compared) / np.maximum(sizes, 1e-30)[:, None]
                best = np.argmax(cosines, axis=1)
                value = np.clip(cosines[np.arange(len(held)), best].astype(float), 0.0, 1.0)
                some = sizes > 0
                found += [langs[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)]
                scores += np.where(some, value, 0.0).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(found, pa.string()),
                    pa.array(scores, pa.float64()),
                    *batch.columns[2:],
                ],
                names=["key", "lang_pred", "score", *batch.schema.names[2:]],
            )

    rows = docs.select(
        F.col(key).alias("key"),
        F.col(text).alias("text"),
        *([F.struct(*docs.columns).alias("row")] if whole_rows else []),
    )
    schema = (
        StructType([rows.schema["key"]])
        .add("lang_pred", "string")
        .add("score", "double")
    )
    if whole_rows:
        schema = schema.add(rows.schema["row"])
    return rows.mapInArrow(nearest, schema).withColumnRenamed("key", key)
