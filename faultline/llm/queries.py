"""The dealt operators over the driver's tables, with SQL oracles where SQL can say it."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions.settle import checkpoint_dir
from faultline.llm import (
    codes,
    curves,
    dialogues,
    langid,
    licences,
    mixing,
    mtree,
    neardup,
    ngramjoin,
    packing,
    pfor,
    quality,
    secretscan,
)

SEQUENCE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
FILE_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _remainder(modulus: int):
    """The held-out rule of the queries: crc32 of the id as text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op1_curve_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return curves.nearest(_table(spark, sf, "embeddings"), "vec_id % 100 = 0", k=10)


def op2_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    held_out = F.coalesce(_remainder(3) == 1, F.lit(False))
    model = langid.train(docs.where(~held_out), sample_key="doc_id")
    return langid.predict(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op3_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf, "documents"), width=4, percent=80)


def op4_secrets(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    model = secretscan.train(secretscan.labelled_samples(docs))
    return secretscan.secret_report(secretscan.scan_secrets(docs, model))


def op5_licences(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return licences.licence_report(licences.scan_licences(docs, templates=licences.REPORTED))


def op6_inner_products(spark: SparkSession, sf: str) -> DataFrame:
    return mtree.top_k(_table(spark, sf, "embeddings"), "vec_id % 20 = 0", k=20)


def op7_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(_table(spark, sf, "documents"), SEQUENCE_TOKENIZER)


def op8_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_table(spark, sf, "documents"))


def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    held_out = F.coalesce(_remainder(4) == 2, F.lit(False))
    model = quality.train(docs, _table(spark, sf, "labels").where(~held_out))
    return quality.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op10_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    pfor.write_tokens(_table(spark, sf, "documents"), path, FILE_TOKENIZER)
    return pfor.read_tokens(spark, path)


def op11_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return dialogues.repaired_report(_table(spark, sf, "conversations"))


def op12_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngramjoin.jaccard_groups(_table(spark, sf, "documents"), width=3, percent=90)


def op13_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    return codes.code_report(_table(spark, sf, "embeddings"))


QUERIES = {
    run.__name__: run
    for run in (
        op1_curve_neighbours,
        op2_language,
        op3_near_duplicates,
        op4_secrets,
        op5_licences,
        op6_inner_products,
        op7_packing,
        op8_mixing,
        op9_quality,
        op10_token_files,
        op11_conversation_repair,
        op12_ngram_join,
        op13_vector_codes,
    )
}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _groups(width: int, percent: int, kept: bool) -> str:
    """Components of documents whose sets of word n-grams overlap enough, from all pairs."""
    last = ", r.doc_id = min(reached) AS kept" if kept else ""
    return f"""WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS ws
      FROM documents),
    s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN []
        WHEN len(ws) < {width} THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - {width - 2}),
          lambda i: array_to_string(ws[i:i + {width - 1}], ' '))
        END) AS grams FROM w),
    n AS (SELECT doc_id, len(grams) AS n FROM s),
    x AS (SELECT doc_id, unnest(grams) AS gram FROM s),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM x a JOIN x b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * c >= {percent} * (na.n + nb.n - c)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r(doc_id, reached) AS (SELECT doc_id, doc_id FROM n
      UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.reached = e.a)
    SELECT r.doc_id, n.n AS n_shingles, min(reached) AS component_id{last}
    FROM r JOIN n ON r.doc_id = n.doc_id GROUP BY r.doc_id, n.n"""


def _codes() -> str:
    """Four rounds over four codebooks of 256 entries, every part against every entry."""
    steps = ["""v AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
      list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
      FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
    """p AS (SELECT r, part, e[part * len(e) // 4 + 1:(part + 1) * len(e) // 4] AS x
      FROM v, (SELECT unnest(range(4)) AS part))""",
    "c0 AS (SELECT part, r - 1 AS entry, x FROM p WHERE r <= 256)"]
    for i in range(5):
        steps.append(f"""a{i} AS (SELECT r, p.part, min({{'d': list_dot_product(p.x, p.x)
        - 2 * list_dot_product(p.x, c.x) + list_dot_product(c.x, c.x), 'e': entry}}) AS best
      FROM p JOIN c{i} c ON p.part = c.part GROUP BY r, p.part)""")
        if i < 4:
            steps.append(f"""m{i} AS (SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY k) AS x
      FROM (SELECT part, entry, k, CAST(sum(value) AS BIGINT) AS s, count(*) AS n
        FROM (SELECT p.part, a.best.e AS entry, unnest(p.x) AS value, unnest(range(len(p.x))) AS k
          FROM p JOIN a{i} a ON p.r = a.r AND p.part = a.part)
        GROUP BY part, entry, k) GROUP BY part, entry),
    c{i + 1} AS (SELECT part, entry, coalesce(m.x, c.x) AS x
      FROM c{i} c LEFT JOIN m{i} m USING (part, entry))""")
    return f"""WITH {", ".join(steps)},
    t AS (SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code,
        CAST(sum(best.d) AS BIGINT) AS error FROM a4 GROUP BY r),
    h AS (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda y: CAST(y AS BIGINT)), ','),
        ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c4)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
      codebooks_sha256 FROM v JOIN t USING (r), h"""


#: The queries whose whole result SQL can say. The others have models, sketches or
#: tokenizers in them; tests hold them against plain Python.
ORACLES = {
    "op3_near_duplicates": _groups(4, 80, kept=True),
    "op6_inner_products": """WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
      FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
    SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
    WHERE place <= 20""",
    "op12_ngram_join": _groups(3, 90, kept=False),
    "op13_vector_codes": _codes(),
}
