"""The registered queries of this folder and the SQL that checks them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, exact, language, licences, mixing, nearcopies, pieces, substrings, suffixes, tokens, toxicity, vectors, whitening
from .shared import remainder

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op2_substrings(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.remove_passages(_read(spark, folder, "documents"), bodies=False)
    return found.select(F.col("id").alias("doc_id"), F.col("n_units").alias("n_words"), "n_removed", "kept_sha256")


def model_path() -> str:
    """The public BPE piece model; SENTENCEPIECE_MODEL names another file."""
    return os.environ.get("SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op1_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    found = vectors.links(_read(spark, folder, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = language.fit(docs.filter(~held_out))
    return language.identify(docs, model).select(
        "doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score", "language.rejected")


def op4_exact(spark: SparkSession, folder: str) -> DataFrame:
    found = exact.deduplicate(_read(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: number and digest of the piece ids, and whether decoding them gives the text again."""
    model = pieces.read_model(model_path())
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    encoded = pieces.encode(docs, model, round_trip="round_trip")
    return encoded.select("doc_id", F.size("pieces").alias("n_pieces"), F.sha2(F.to_json("pieces"), 256).alias("pieces_sha256"), "round_trip")


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _read(spark, folder, "documents"), _read(spark, folder, "labels")
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    grammar = toxicity.fit(docs, labels.filter(~held_out))
    return toxicity.score(docs.select("doc_id", "text"), grammar, out="score").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = nearcopies.near_copies(_read(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


def op8_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.remove_strings(_read(spark, folder, "documents"), bodies=False)
    return found.select(F.col("id").alias("doc_id"), F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    taken = mixing.mix(_read(spark, folder, "documents")).documents
    return taken.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op10_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Per document and licence family: notices found, and the best probability and overlap among them."""
    found = licences.scan(_read(spark, folder, "documents"), licences.fit(spark))
    return found.groupBy(F.col("id").alias("doc_id"), "family").agg(
        F.sum("n").alias("n_notices"), F.max("probability").alias("probability"), F.max("overlap").alias("overlap"))


def vocabulary_path() -> str:
    """The public byte-level vocabulary; BYTE_VOCABULARY names another file."""
    return os.environ.get("BYTE_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.json")


def op11_tokens(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, tokens.read_vocabulary(vocabulary_path())).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(_read(spark, folder, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "component", "n", "deviation", "whitened", "explained", "identity_error")


def op13_filters(spark: SparkSession, folder: str) -> DataFrame:
    return audit.interactions(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


QUERIES: dict[str, Query] = {
    "op1_embeddings": op1_embeddings,
    "op2_substrings": op2_substrings,
    "op3_language": op3_language,
    "op4_exact": op4_exact,
    "op5_pieces": op5_pieces,
    "op6_toxicity": op6_toxicity,
    "op7_minhash": op7_minhash,
    "op8_suffixes": op8_suffixes,
    "op9_mixing": op9_mixing,
    "op10_licences": op10_licences,
    "op11_tokens": op11_tokens,
    "op12_whitening": op12_whitening,
    "op13_filters": op13_filters,
}

ORACLE_SQL: dict[str, str] = {
    "op1_embeddings": """
        WITH RECURSIVE sound AS (
          SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
          WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x != 0)) > 0),
        links AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id != b.vec_id
          WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
        reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
        SELECT vec_id, coalesce((SELECT count(*) FROM links WHERE a = vec_id), 0)::BIGINT AS n_links,
               least(vec_id, coalesce(least.b, vec_id)) AS component_id,
               vec_id = least(vec_id, coalesce(least.b, vec_id)) AS kept
        FROM embeddings LEFT JOIN least ON vec_id = least.a""",
    "op2_substrings": r"""
        WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        windows AS (
          SELECT doc_id, p, sha256(array_to_string(words[p:p + 19], ' ')) AS content
          FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 19)) AS p FROM docs)),
        firsts AS (SELECT content, min(struct_pack(d := doc_id, q := p)) AS f FROM windows GROUP BY content),
        covered AS (
          SELECT doc_id, list(DISTINCT p + step) AS gone
          FROM windows JOIN firsts USING (content), range(20) AS r(step)
          WHERE f != struct_pack(d := doc_id, q := p) GROUP BY doc_id),
        marked AS (
          SELECT doc_id, words, [i IN coalesce(gone, []) FOR i IN generate_series(1, len(words))] AS mask
          FROM docs LEFT JOIN covered USING (doc_id))
        SELECT doc_id, len(words)::BIGINT AS n_words, len(list_filter(mask, lambda m: m))::BIGINT AS n_removed,
               sha256(array_to_string(list_filter(words, lambda w, i: NOT mask[i]), ' ')) AS kept_sha256
        FROM marked""",
    "op4_exact": r"""
        WITH texts AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
        groups AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY body)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(body) AS text_sha256
        FROM texts JOIN groups USING (body)""",
    "op7_minhash": r"""
        WITH RECURSIVE docs AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x20\x09-\x0D]+') AS words FROM documents),
        shingles AS (
          SELECT DISTINCT doc_id, array_to_string(words[p:p + 4], ' ') AS s
          FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS p FROM docs WHERE len(words) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        pairs AS (
          SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
          FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id != b.doc_id GROUP BY 1, 2),
        links AS (
          SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * common >= 85 * (x.n + y.n - common)),
        reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
        SELECT docs.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(docs.doc_id, coalesce(least.b, docs.doc_id)) AS component_id,
               docs.doc_id = least(docs.doc_id, coalesce(least.b, docs.doc_id)) AS kept
        FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON docs.doc_id = least.a""",
    "op9_mixing": r"""
        WITH sized AS (
          SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                 md5(coalesce(doc_id::VARCHAR, '')) AS shuffle
          FROM documents),
        totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
        numbered AS (
          SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS no FROM totals),
        weighed AS (SELECT *, CASE no % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM numbered),
        levels AS (
          SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(source_size * 2.0::DOUBLE) OVER fill, 0))
                    / (sum(weight) OVER () - coalesce(sum(weight) OVER fill, 0)) AS level
          FROM weighed
          WINDOW fill AS (ORDER BY source_size / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        aims AS (
          SELECT no, source, source_size,
                 least(source_size * 2.0::DOUBLE,
                       max(level) OVER () * weight) AS target
          FROM levels),
        stakes AS (
          SELECT *, greatest(target, sum(target) OVER () * (64::DOUBLE / (SELECT greatest(262144, 512 * count(*)) FROM aims))) AS stake
          FROM aims WHERE target > 0),
        stretches AS (
          SELECT *, CASE WHEN lead(no) OVER (ORDER BY no) IS NULL THEN 1.0
                         ELSE sum(stake) OVER (ORDER BY no) / sum(stake) OVER () END AS high FROM stakes),
        points AS (
          SELECT slot, (slot + 0.5::DOUBLE) * 0.6180339887498949::DOUBLE - floor((slot + 0.5::DOUBLE) * 0.6180339887498949::DOUBLE) AS point
          FROM range((SELECT greatest(262144, 512 * count(*)) FROM aims)) AS r(slot)),
        slots AS (SELECT point, no FROM points ASOF JOIN (SELECT no, coalesce(lag(high) OVER (ORDER BY no), 0.0) AS low FROM stretches) s
                  ON point >= low),
        plans AS (
          SELECT aims.*, n, ceil(n * source_size / target)::BIGINT AS blocks
          FROM aims LEFT JOIN (SELECT no, count(*) AS n FROM slots GROUP BY no) USING (no)),
        ends AS (
          SELECT *, sum(size) OVER (PARTITION BY source ORDER BY shuffle, doc_id, size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS stop
          FROM sized),
        placed AS (
          SELECT e.doc_id, e.size, p.source_size, p.target, p.n, p.blocks, e.stop - e.size AS start, e.stop
          FROM ends e JOIN plans p ON e.source IS NOT DISTINCT FROM p.source)
        SELECT doc_id, size, source_size, target,
               CASE WHEN size = 0 OR blocks IS NULL THEN 0 ELSE (n // blocks) * size
                 + least(stop, (n % blocks) * source_size // blocks) - least(start, (n % blocks) * source_size // blocks) END::BIGINT AS taken
        FROM placed""",
    "op13_filters": r"""
        WITH split AS (
          SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
                 regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        marks AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
        fails AS (
          SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad,
                 [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
                  100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body),
                  regexp_matches(body, '[#$%&*|]'),
                  coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), min(doc_id) OVER (PARTITION BY body) IS NOT NULL)] AS f
          FROM split LEFT JOIN marks USING (doc_id)),
        sets AS (
          SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM fails GROUP BY part, f),
        letters AS (SELECT unnest(range(1, 6)) AS l),
        orders AS (
          SELECT [a.l, b.l, c.l, d.l, e.l] AS o FROM letters a, letters b, letters c, letters d, letters e
          WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
        steps AS (SELECT o, s AS step, o[s] AS l, o[1:s - 1] AS earlier FROM orders, (SELECT unnest(range(1, 6)) AS s)),
        judged AS (
          SELECT part, o, step, l, n, good, bad, f[l] AS failing, len(list_filter(earlier, lambda x: f[x])) > 0 AS gone,
                 len(list_filter(f, lambda x: x)) = 1 AS alone
          FROM sets, steps),
        report AS (
          SELECT part, o, step, l, coalesce(sum(n) FILTER (NOT failing AND NOT gone), 0)::BIGINT AS kept,
                 coalesce(sum(n) FILTER (failing AND NOT gone), 0)::BIGINT AS removed,
                 coalesce(sum(n) FILTER (failing AND gone), 0)::BIGINT AS redundant,
                 coalesce(sum(n) FILTER (failing AND alone), 0)::BIGINT AS unique_fails,
                 coalesce(sum(good) FILTER (failing AND NOT gone), 0)::BIGINT AS good_lost,
                 coalesce(sum(bad) FILTER (failing AND NOT gone), 0)::BIGINT AS toxic_lost
          FROM judged GROUP BY part, o, step, l)
        SELECT part, array_to_string(list_transform(o, lambda x: 'ABCDE'[x]), '') AS filter_order, step::INTEGER AS step, kept, removed, redundant,
               unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, l)::BIGINT AS shapley
        FROM report""",
}
