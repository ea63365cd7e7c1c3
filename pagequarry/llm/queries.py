"""The operators' queries over the tables, with production parameters, and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.llm.conversation_repair import repair_conversations
from pagequarry.llm.decontaminate import contamination
from pagequarry.llm.language_id import identify
from pagequarry.llm.licenses import license_scan
from pagequarry.llm.maxscore import top_k
from pagequarry.llm.minhash_dedup import near_dedup
from pagequarry.llm.mixing import mix_sources
from pagequarry.llm.pii import personal_data
from pagequarry.llm.secrets import secret_scan
from pagequarry.llm.simhash_dedup import simhash_dedup
from pagequarry.llm.substring_dedup import substring_dedup
from pagequarry.llm.toxicity import score_toxicity
from pagequarry.llm.vector_codes import vector_codes


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents"), with_text=False).drop("kept_text")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"))


def op3_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources and languages are the directories of documents."""
    docs = _table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.expr("cast(doc_id div 1000 as string)"), F.col("doc_id").cast("string"))
    return license_scan(docs, path)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(_table(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(_table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(_table(spark, sf_dir, "conversations"))


def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(_table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_substring_dedup, op2_language_id, op3_maxscore, op4_minhash_dedup, op5_toxicity, op6_decontaminate, op7_mix_sources, op8_license_scan,
                            op9_secret_scan, op10_personal_data, op11_conversation_repair, op12_simhash_dedup, op13_vector_codes)
}

_CRC = """list_reduce([4294967295::BIGINT] || list_transform(string_split(key, ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda crc, c: list_reduce([xor(crc, c)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
      lambda x, bit: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END))"""

_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"



def _vector_codes_sql() -> str:
    """Plain distances from every part to every entry, round by round."""
    def nearest(book: str) -> str:
        return f"""SELECT vec_id, v.p, min(CAST(list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS HUGEINT) * 64 + e) AS best
          FROM cut v JOIN {book} b ON b.p = v.p GROUP BY vec_id, v.p"""

    def moved(book: str, chosen: str) -> str:
        return f"""SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM {book} b LEFT JOIN (
            SELECT p, e, list(c ORDER BY i) AS x FROM (
              SELECT a.p, CAST(best % 64 AS BIGINT) AS e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS c
              FROM {chosen} a JOIN cut USING (vec_id, p), LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i) GROUP BY 1, 2, 3) GROUP BY 1, 2) m
          ON m.p = b.p AND m.e = b.e"""

    return f"""
        WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        cut AS (SELECT vec_id, p, q[p * (len(q) // 16) + 1 : (p + 1) * (len(q) // 16)] AS x FROM v, (SELECT unnest(range(16)) AS p)),
        b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM cut QUALIFY e < 64),
        a0 AS MATERIALIZED ({nearest("b0")}), b1 AS MATERIALIZED ({moved("b0", "a0")}), a1 AS MATERIALIZED ({nearest("b1")}),
        b2 AS MATERIALIZED ({moved("b1", "a1")}), a2 AS ({nearest("b2")}),
        c AS (SELECT vec_id, string_agg(printf('%02x', CAST(best % 64 AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(best // 64) AS BIGINT) AS error
              FROM a2 GROUP BY vec_id)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
          (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM b2) AS codebooks_sha256
        FROM c JOIN v USING (vec_id)
    """


ORACLE: dict[str, str] = {
    "op3_maxscore": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
                   WHERE embedding IS NOT NULL AND len(embedding) > 0
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
                     CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
              FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
    """,
    "op7_mix_sources": f"""
        WITH d AS (SELECT doc_id, source, CAST(coalesce(len({_WORDS}), 0) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key
                   FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
        w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
        c AS (SELECT *, 3 * source_size / CAST(weight AS DOUBLE) AS stop,
                     sum(3 * source_size) OVER x - 3 * source_size AS caps, sum(weight) OVER x - weight AS weights
              FROM w WINDOW x AS (ORDER BY 3 * source_size / CAST(weight AS DOUBLE), source NULLS LAST ROWS UNBOUNDED PRECEDING)),
        l AS (SELECT *, CAST((SELECT sum(source_size) FROM w) - caps AS DOUBLE) / CAST((SELECT sum(weight) FROM w) - weights AS DOUBLE) AS level FROM c),
        f AS (SELECT arg_min(level, stop) AS level FROM l WHERE stop >= level),
        t AS (SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), f.level * weight) AS target FROM w, f),
        p AS (SELECT d.*, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
                     coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
               CAST(size * (budget // greatest(source_size, 1))
                    + greatest(0, least(size, budget - (budget // greatest(source_size, 1)) * source_size - before)) AS BIGINT) AS taken,
               source
        FROM p
    """,
    # one state after the other, with the least audit and its rows so far: no divide and conquer
    "op11_conversation_repair": f"""
        WITH RECURSIVE keyed AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
        drawn AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor({_CRC}, 4294967295::BIGINT) % 20 AS hit FROM keyed),
        harmed AS (SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
            CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
            unnest(range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM drawn),
        ranked AS (SELECT *, row_number() OVER w AS n, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again,
            lag(role) OVER w AS before, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM harmed
          WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
        judged AS (SELECT *, left(role, 1) AS initial, CASE WHEN body = '' THEN 'blank' WHEN again > 1 THEN 'duplicate'
            WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM ranked),
        next(state, after, role) AS (VALUES ('', 'u', 'user'), ('s', 'u', 'user'), ('u', 'a', 'assistant'), ('a', 'u', 'user')),
        kept(state, initial) AS (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
        added AS (SELECT state, state AS after, 0 AS cost, '' AS edits, CAST([] AS VARCHAR[]) AS made FROM next
          UNION ALL SELECT state, after, 2, 'I', [role || ':'] FROM next
          UNION ALL SELECT a.state, b.after, 4, 'II', [a.role || ':', b.role || ':'] FROM next a JOIN next b ON b.state = a.after),
        path AS (SELECT conv_id, 0::BIGINT AS n, '' AS state, 0::BIGINT AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines
            FROM (SELECT DISTINCT conv_id FROM judged)
          UNION ALL (SELECT * FROM (
            SELECT p.conv_id, p.n + 1 AS n, w.after AS state, p.cost + a.cost + w.cost AS cost, p.audit || a.edits || w.edit AS audit,
              p.lines || a.made || w.line AS lines
            FROM path p JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.n = p.n + 1 JOIN added a ON a.state = p.state,
            LATERAL (SELECT a.after, 3 AS cost, 'D' AS edit, CAST([] AS VARCHAR[]) AS line
              UNION ALL SELECT x.after, 2 + CAST(j.fault = 'truncated' AS INTEGER), 'R', [x.role || ':' || j.text] FROM next x
                WHERE x.state = a.after AND j.fault NOT IN ('blank', 'duplicate')
              UNION ALL SELECT j.initial, CAST(j.fault = 'truncated' AS INTEGER), 'K', [j.role || ':' || j.text] FROM kept k
                WHERE k.state = a.after AND k.initial = j.initial AND j.fault NOT IN ('blank', 'duplicate')) w)
            QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1)),
        ends AS (SELECT p.conv_id, p.cost + a.cost AS cost, p.audit || a.edits AS audit, p.lines || a.made AS lines
          FROM path p JOIN (SELECT conv_id, count(*) AS n FROM judged GROUP BY conv_id) c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.n
          JOIN added a ON a.state = p.state AND a.after IN ('', 'a')
          QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + a.cost, p.audit || a.edits) = 1),
        told AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
            count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
            count(*) FILTER (WHERE before IS NOT NULL AND left(before, 1) || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
          coalesce(illegal, 0) AS illegal, coalesce(CAST(cost AS BIGINT), 0) AS cost, coalesce(audit, '') AS audit,
          sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
    """,
    "op13_vector_codes": _vector_codes_sql(),
}
