"""The thin queries opN_<name> over whole tables, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, langid, lexical, linededup, mixing, nearsets, perspectives, pitmanyor, quality, repair, rollups, secrets, substrings
from .common import checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Words, as DuckDB's RE2 takes them.
_WORD = r"[^\x20\x09-\x0D]+"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup of all documents: lines, removed lines, and the left text's SHA-256."""
    left = linededup.dedup(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", *linededup.RESULT, F.sha2("text", 256).alias("kept_sha256"))


def op2_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations from every participant's side, piece by piece."""
    pieces = perspectives.rotate(_table(spark, sf_dir, "conversations"))
    return pieces.withColumn("piece_md5", F.md5("piece")).drop("piece")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of all documents, judged by a forest trained on planted findings; the lexicon is that of all documents."""
    docs = _table(spark, sf_dir, "documents")
    known = secrets.lexicon(docs)
    found = secrets.findings(secrets.planted(spark, known), known)
    forest = secrets.train(found.where("NOT held_out"))
    return secrets.scan(docs, forest, known).select("doc_id", "word_index", "candidate", "score", "is_secret")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: words taken of each."""
    return mixing.take(_table(spark, sf_dir, "documents")).select("doc_id", *mixing.RESULT)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents in windows that occur elsewhere."""
    return substrings.dedup(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    found = decontam.hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start_word", F.round("similarity", 9).alias("similarity"), "distance")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by the model of those not held out."""
    return pitmanyor.score(_table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return nearsets.classes(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "n_verified", "kept")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rollup of all documents after inserts, deletes, revised counts and a repeated batch."""
    checkpoint_dir(spark)
    docs = _table(spark, sf_dir, "documents")
    part = F.coalesce(F.pmod("doc_id", F.lit(10)), F.lit(0))
    rollup = rollups.Rollup(spark, f"{spark.sparkContext.getCheckpointDir()}/rollup-{uuid.uuid4().hex}")
    rollup.commit("1", rollups.changes(docs, "words-v1", 1))
    rollup.commit("2", rollups.changes(docs.where(part == 0), "words-v1", -1))
    rollup.commit("3", rollups.revisions(docs.where(part == 1), "words-v1", "pieces-v2"))
    rollup.commit("2", rollups.changes(docs.where(part == 0), "words-v1", -1))
    return rollup.totals()


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over all documents."""
    judged = quality.annotate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.RESULT)


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, by a model of those that aren't held out."""
    return langid.label(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), keep_text=False).select("doc_id", *langid.RESULT)


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of each conversation after damage."""
    return repair.repair(repair.damage(_table(spark, sf_dir, "conversations")))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return lexical.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


for _query in (op1_line_dedup, op2_perspectives, op3_secrets, op4_mixing, op5_substring_dedup, op6_decontamination, op7_lm_score, op8_near_dedup, op9_token_counts, op10_quality, op11_language_id, op12_repair, op13_search):
    QUERIES[_query.__name__] = _query

ORACLE["op4_mixing"] = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
         CAST(('0x' || substr(md5('{mixing.SEED}/' || coalesce(CAST(doc_id AS VARCHAR), 'null/' || md5(coalesce(text, '')))), 1, 15)) AS BIGINT) AS k, md5(coalesce(text, '')) AS tie
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
         source_size * 2.0::DOUBLE AS full_size FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(full_size) OVER (ORDER BY full_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
            / sum(w) OVER (ORDER BY full_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
free AS (SELECT arg_min(level, full_size / w) AS free_level FROM levels WHERE level * w < full_size),
goals AS (SELECT source, source_size, least(full_size, coalesce(free_level * w, full_size)) AS target FROM levels, free),
placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size, s.tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS front,
         CAST(round(g.target) AS BIGINT) AS goal
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST((goal // greatest(source_size, 1)) * size + greatest(0, least(size, goal % greatest(source_size, 1) - front)) AS BIGINT) AS taken
FROM placed
"""

ORACLE["op2_perspectives"] = """
WITH r AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM r WHERE speaker <> 'system'),
each AS (
  SELECT r.*, p.perspective,
         CASE WHEN r.speaker = 'system' THEN 'system' WHEN r.speaker = p.perspective THEN 'assistant' ELSE 'user' END AS out_role
  FROM r JOIN people p ON r.conv_id IS NOT DISTINCT FROM p.conv_id),
headed AS (
  SELECT *, '<|im_start|>' || out_role || CASE WHEN out_role = 'user' THEN ' name=' || replace(speaker, '<|', '< |') ELSE '' END || chr(10) AS head FROM each),
pieces AS (SELECT *, head || replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS piece FROM headed),
placed AS (
  SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS LAST, speaker, text
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS front FROM pieces)
SELECT conv_id, perspective, turn, speaker, out_role AS role, out_role = 'assistant' AS loss, CAST(front AS BIGINT) AS start,
       CASE WHEN out_role = 'assistant' THEN CAST(front + length(head) AS BIGINT) END AS loss_start, CAST(front + length(piece) AS BIGINT) AS "end", md5(piece) AS piece_md5
FROM placed
"""

ORACLE["op9_token_counts"] = rf"""
WITH w AS (
  SELECT source, lang, coalesce(((doc_id % 10) + 10) % 10, 0) AS part,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS words,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{rollups.PIECES}')) AS BIGINT) AS pieces
  FROM documents)
SELECT source, lang, CASE WHEN part = 1 THEN 'pieces-v2' ELSE 'words-v1' END AS tokenizer, count(*) AS n_docs,
       CAST(sum(CASE WHEN part = 1 THEN pieces ELSE words END) AS BIGINT) AS n_tokens
FROM w WHERE part <> 0 GROUP BY ALL
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS = f"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')"
ORACLE["op13_search"] = f"""
WITH items AS (SELECT row_number() OVER () AS item, item_id, list_distinct({_TERMS}) AS terms FROM benchmark),
asked AS (SELECT item, item_id, unnest(terms) AS term FROM items),
docs AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS terms FROM documents),
sums AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS n_docs, CAST(coalesce(sum(len(terms)), 0) AS BIGINT) AS n_terms FROM docs),
placed AS (SELECT rid, doc_id, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM docs),
tf AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM placed WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, sums GROUP BY term, n_docs),
found AS (
  SELECT item, item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM tf JOIN weights USING (term) JOIN asked USING (term), sums GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank, doc_id, score
FROM found WHERE score > 0 QUALIFY rank <= 10
"""
