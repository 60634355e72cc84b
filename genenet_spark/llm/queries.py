"""Registered queries of the operators: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genenet_spark.llm import (ann, bpe, centroids, chat, decontaminate, jaccard, language, lines, lm_scoring, repeats, token_counts,
                               token_file, whitening)
from genenet_spark.llm.common import doc_crc, scratch_path, table

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1 over all documents, learning from six of seven folds."""
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2 over all embeddings: the five nearest of each row whose id is divisible by 50."""
    return ann.search(table(spark, sf_dir, "embeddings"))


def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3: all documents written as a token file and read back from it."""
    path = scratch_path(spark, "token-file")
    token_file.write_token_file(table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE))
    return token_file.read_token_file(spark, path)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4 over all documents, with ``source`` as the site."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.drop_boilerplate(docs)


OP4_SQL = f"""
WITH l AS (
  SELECT rid, doc_id, source, unnest(a) AS line, unnest(range(len(a))) AS pos
  FROM (SELECT row_number() OVER () AS rid, doc_id, source, string_split(text, chr(10)) AS a FROM documents)),
k AS (SELECT *, trim(replace(replace(line, chr(13), ' '), chr(9), ' ')) AS bare FROM l),
site AS (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source),
bad AS (
  SELECT k.source, bare FROM k JOIN site USING (source) WHERE bare <> ''
  GROUP BY k.source, bare, site.n HAVING count(DISTINCT rid) > 1 AND count(DISTINCT rid) > CAST({lines.MAX_RATIO} AS DOUBLE) * site.n),
cut AS (SELECT k.*, bad.bare IS NOT NULL AS gone FROM k LEFT JOIN bad ON k.source = bad.source AND k.bare = bad.bare)
SELECT doc_id, source, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text, count(*) AS lines,
       CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS lines_cut
FROM cut GROUP BY rid, doc_id, source
UNION ALL SELECT doc_id, source, text, 0, 0 FROM documents WHERE text IS NULL
"""


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5: the benchmark items that leaked into documents."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _sql_shingles(name: str, key: str, n: int = decontaminate.WORDS) -> str:
    w = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"
    return (f"SELECT {key}, array_to_string(w[i:i + {n - 1}], ' ') AS s FROM (SELECT {key}, w, unnest(range(1, len(w) - {n - 2})) AS i "
            f"FROM (SELECT {key}, {w} AS w FROM {name}) WHERE len(w) >= {n})")


OP5_SQL = f"""
WITH d AS MATERIALIZED ({_sql_shingles("documents", "doc_id")}),
i AS MATERIALIZED (SELECT DISTINCT * FROM ({_sql_shingles("benchmark", "item_id")})),
z AS (SELECT item_id, count(*) AS n FROM i GROUP BY item_id)
SELECT doc_id, item_id, count(DISTINCT s) AS shared, z.n AS item_shingles, count(DISTINCT s) / z.n::DOUBLE AS containment
FROM d JOIN i USING (s) JOIN z USING (item_id) GROUP BY doc_id, item_id, z.n
HAVING count(DISTINCT s) >= ceil(z.n * {decontaminate.THRESHOLD} - 1e-9)
"""


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6 over all documents: components of links by 3-word shingles at a Jaccard similarity of 0.9."""
    return jaccard.link_components(table(spark, sf_dir, "documents"), n=3, percent=90)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7 over all documents, with a cache that is empty at first."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE),
                                     scratch_path(spark, "token-counts"))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8 over all documents: token counts, digests of the ids and of the decoded text."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), with_ids=False)


PLANTED_TURNS = [(-7, 0, "user"), (-7, 1, "assistant")]
PLANTED_TEXT = r"\### Assistant: </turn> ok"


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9 over all conversations and the one of control strings, read back from the formatted texts."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(*t, PLANTED_TEXT) for t in PLANTED_TURNS], "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.format_conversations(rows.unionByName(planted)))
    nl = F.lit("\n")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], nl, t["text"], nl)), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


OP9_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, replace(replace(replace(role, '\', '\b'), '<', '\l'), '|', '\p') AS erole,
         replace(replace(replace(text, '\', '\b'), '<', '\l'), '|', '\p') AS etext,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(etext) + CASE WHEN before IS NULL OR before <> role THEN length(erole) + 12 ELSE 5 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10: learn from the documents of four of five folds, predict all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", doc_crc(F.col("doc_id")) % 5 == 0)
    model = language.train(docs.where(~F.col("held_out")))
    return language.predict(docs, model, {"doc_id": "long", "held_out": "boolean"})


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11 over all embeddings: four whitened components of every row."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13 over all documents: bytes covered by 100-byte strings that start earlier are removed."""
    out = repeats.drop_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12 over all embeddings: 16 centroids, three rounds, exact whole numbers."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def _sql_centroids() -> str:
    dim, count = centroids.DIM, centroids.CENTROIDS
    steps = [f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id,
         [CAST(floor(CAST(v AS DOUBLE) * {centroids.FACTOR}) AS BIGINT) FOR v IN embedding] AS x FROM embeddings
  WHERE len(embedding) = {dim} AND len([v FOR v IN embedding IF v IS NOT NULL AND isfinite(v)]) = {dim}),
e AS MATERIALIZED (SELECT rid, unnest(x) AS v, unnest(range({dim})) AS i FROM k),
s AS (SELECT x, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, x) - 1 AS c FROM k QUALIFY c < {count}),
c0 AS MATERIALIZED (SELECT c, unnest(x) AS v, unnest(range({dim})) AS i FROM s)"""]
    for r in range(centroids.ROUNDS + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT rid, c, d FROM (SELECT rid, c, CAST(sum((e.v - c{r}.v) * (e.v - c{r}.v)) AS BIGINT) AS d FROM e JOIN c{r} USING (i) GROUP BY rid, c)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)""")
        if r < centroids.ROUNDS:
            steps.append(f"""
m{r} AS (SELECT a{r}.c, e.i, sum(e.v) AS total, count(*) AS n FROM e JOIN a{r} USING (rid) GROUP BY a{r}.c, e.i),
c{r + 1} AS MATERIALIZED (
  SELECT c{r}.c, c{r}.i, CAST(coalesce((total - ((total % n) + n) % n) // n, c{r}.v) AS BIGINT) AS v
  FROM c{r} LEFT JOIN m{r} ON c{r}.c = m{r}.c AND c{r}.i = m{r}.i)""")
    last = centroids.ROUNDS
    return ",".join(steps) + f""",
g AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{last} GROUP BY c)
SELECT k.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, g.centroid_sha256
FROM a{last} a JOIN k USING (rid) JOIN g ON a.c = g.c
"""


OP12_SQL = _sql_centroids()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_score": op1_lm_score,
    "op2_neighbours": op2_neighbours,
    "op3_token_file": op3_token_file,
    "op4_line_dedup": op4_line_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_token_counts": op7_token_counts,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_chat": op9_chat,
    "op10_language": op10_language,
    "op11_whitening": op11_whitening,
    "op12_centroids": op12_centroids,
    "op13_repeats": op13_repeats,
}

#: DuckDB SQL for the same rows, where SQL can express the operator.
ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": OP4_SQL,
    "op5_decontamination": OP5_SQL,
    "op9_chat": OP9_SQL,
    "op12_centroids": OP12_SQL,
}
