"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_engine.llm import common as C
from telemetry_engine.llm import decontaminate, huffman, jaccard, licenses, packing, pii, preference, quality, repair, sharding, tokens, topk, toxicity, whitening


def byte_bpe() -> str:
    import public_tokenizers

    return tokens.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(C.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op2_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = C.work_dir(spark, "token_binary")
    huffman.write_ids(C.table(spark, sf_dir, "documents"), path, byte_bpe(), end_id=0)
    return huffman.read_digests(spark, path)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    model = quality.train(docs, C.table(spark, sf_dir, "labels"))
    return toxicity.result(quality.scored(docs, model), 0.5)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(C.table(spark, sf_dir, "documents"), byte_bpe())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    model = toxicity.train(docs, C.table(spark, sf_dir, "labels"))
    return toxicity.result(toxicity.scored(docs, model, with_text=False), 0.7)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(C.table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.train(docs)).withColumn("paragraph", F.col("paragraph").cast("long"))


def op9_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws("-", x["start"], x["end"])), ",")
    rows = preference.preferences(C.table(spark, sf_dir, "conversations"))
    return (rows.withColumn("chosen_spans", text("chosen_spans")).withColumn("rejected_spans", text("rejected_spans"))
            .withColumn("prompt_turns", F.col("prompt_turns").cast("long")))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(C.table(spark, sf_dir, "documents")).drop("rid", "text_key")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(C.table(spark, sf_dir, "conversations"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whole(C.table(spark, sf_dir, "embeddings"))
    return whitening.whitened(rows, whitening.train(rows))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.interleaved(C.table(spark, sf_dir, "documents"), keep=["doc_id"])
    return rows.withColumn("grown_shard", F.lit(None).cast("int"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_token_binary": op2_token_binary,
    "op3_quality": op3_quality,
    "op4_packing": op4_packing,
    "op5_decontamination": op5_decontamination,
    "op6_toxicity": op6_toxicity,
    "op7_pii": op7_pii,
    "op8_license_scan": op8_license_scan,
    "op9_preference": op9_preference,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_whitening": op12_whitening,
    "op13_sharding": op13_sharding,
}


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text, four bits at a time."""
    table = []
    for c in range(16):
        for _ in range(4):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    nibbles = (f"list_transform(string_split(regexp_replace(hex(encode({text})), '(.)(.)', '\\2\\1', 'g'), ''), "
               "lambda c: CAST(strpos('0123456789ABCDEF', c) - 1 AS BIGINT))")
    step = f"lambda a, v: xor(a >> 4, CAST({table}[(xor(a, v) & 15) + 1] AS BIGINT))"
    return (f"(CASE WHEN {text} = '' THEN 0 ELSE xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {nibbles}), {step}), "
            "4294967295) END)")


def _md5_sql(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def _edits_sql() -> str:
    """Least (cost, initials) from each state of the role pattern to the end, a row at a time from the last.

    A value is the cost in nine digits and then the initials, so that texts compare as pairs.
    """
    add = lambda cost, letter, rest: (
        f"(lpad(CAST(CAST(substr({rest}, 1, 9) AS INTEGER) + {cost} AS VARCHAR), 9, '0') || '{letter}' || substr({rest}, 10))")
    cut = "(CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END)"
    none = "'999999999'"
    taken = []
    for q, (kept, made) in enumerate([({"s": 1, "u": 2}, 2), ({"u": 2}, 2), ({"a": 3}, 3), ({"u": 2}, 2)]):
        keep = " ".join(f"WHEN initial = '{c}' THEN {add(cut, 'K', f'g{to}')}" for c, to in kept.items())
        taken.append(f"least({add(4, 'D', f'g{q}')}, CASE WHEN gone THEN {none} {keep} ELSE {none} END, "
                     f"CASE WHEN gone THEN {none} ELSE {add(f'3 + {cut}', 'R', f'g{made}')} END) AS h{q}")
    insert = lambda x: add(3, "I", x)
    two, three = f"least(h2, {insert('h3')})", f"least(h3, {insert('h2')})"
    return f"""
  SELECT conv_id, i - 1 AS i, least(h0, {insert(two)}) AS g0, least(h1, {insert(two)}) AS g1, {two} AS g2, {three} AS g3
  FROM (SELECT b.conv_id, b.i, {', '.join(taken)}
        FROM best b JOIN faults f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i)"""


ORACLE: dict[str, str] = {
    "op11_conversation_repair": f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
coded AS (SELECT *, {_crc32_sql("k")} % 20 AS code FROM given),
hurt AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN code = 1 THEN '' WHEN code = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM coded, (VALUES (1), (2)) c(n) WHERE code <> 0 AND (n = 1 OR code = 3)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), text) AS i,
         substr(role, 1, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid
  FROM hurt),
faults AS (
  SELECT conv_id, i, turn, role, text, initial,
         CASE WHEN solid = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         fault IN ('blank', 'duplicate') AS gone,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM ordered),
best AS (
  SELECT conv_id, max(i) AS i, '000000000' AS g0, '000000006II' AS g1, '000000003I' AS g2, '000000000' AS g3
  FROM faults GROUP BY conv_id
  UNION ALL {_edits_sql()}),
audits AS (
  SELECT conv_id, CAST(substr(g0, 1, 9) AS BIGINT) AS cost, substr(g0, 10) AS audit FROM best WHERE i = 0),
letters AS (
  SELECT conv_id, p, substr(audit, CAST(p AS BIGINT), 1) AS letter
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM audits)),
placed AS (
  SELECT *, CASE WHEN letter <> 'I' THEN count(*) FILTER (WHERE letter <> 'I') OVER (PARTITION BY conv_id ORDER BY p) END AS i
  FROM letters),
kept AS (
  SELECT p.conv_id, p.p, p.letter, f.role, f.text, f.initial,
         row_number() OVER (PARTITION BY p.conv_id ORDER BY p.p) AS e
  FROM placed p LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i WHERE p.letter <> 'D'),
lines AS (
  SELECT conv_id, p, CASE WHEN letter = 'K' THEN role
                          WHEN (e + max(CASE WHEN e = 1 AND letter = 'K' AND initial = 's' THEN 1 ELSE 0 END)
                                    OVER (PARTITION BY conv_id)) % 2 = 1 THEN 'user' ELSE 'assistant' END
                     || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END AS line
  FROM kept),
texts AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY p) AS repaired FROM lines GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id)
SELECT g.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM g.conv_id
""",
    "op1_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, q.e AS query, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM (SELECT DISTINCT vec_id, e FROM v WHERE vec_id % 100 = 0) q
  JOIN v c ON c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id, query ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""",
    "op9_preference": """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'),
                                     coalesce(text, '')) AS k,
         coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
ends AS (
  SELECT conv_id, max(k) AS last, min(k) AS first FROM t WHERE role = 'assistant' GROUP BY conv_id),
replies AS (
  SELECT e.conv_id, e.last, f.text AS first_text FROM ends e
  JOIN t f ON f.conv_id = e.conv_id AND f.k = e.first
  JOIN t l ON l.conv_id = e.conv_id AND l.k = e.last WHERE f.text <> l.text),
heads AS (
  SELECT role, text, min(conv_id) AS chosen_id FROM t WHERE k = 1 GROUP BY role, text),
openings AS (
  SELECT h.chosen_id, t.conv_id AS rejected_id FROM t JOIN heads h ON h.role = t.role AND h.text = t.text
  WHERE t.k = 1 AND t.conv_id <> h.chosen_id),
sides AS (
  SELECT 'reply' AS kind, r.conv_id AS chosen_id, r.conv_id AS rejected_id, 'c' AS side, t.k, t.role, t.text
  FROM replies r JOIN t ON t.conv_id = r.conv_id AND t.k <= r.last
  UNION ALL
  SELECT 'reply', r.conv_id, r.conv_id, 'r', t.k, t.role, CASE WHEN t.k = r.last THEN r.first_text ELSE t.text END
  FROM replies r JOIN t ON t.conv_id = r.conv_id AND t.k <= r.last
  UNION ALL
  SELECT 'opening', o.chosen_id, o.rejected_id, 'c', t.k, t.role, t.text
  FROM openings o JOIN t ON t.conv_id = o.chosen_id
  UNION ALL
  SELECT 'opening', o.chosen_id, o.rejected_id, 'r', t.k, t.role, t.text
  FROM openings o JOIN t ON t.conv_id = o.rejected_id),
prefix AS (
  SELECT kind, chosen_id, rejected_id, min(k) AS differ FROM (
    SELECT kind, chosen_id, rejected_id, k FROM sides GROUP BY kind, chosen_id, rejected_id, k
    HAVING count(*) < 2 OR min(role) <> max(role) OR min(text) <> max(text))
  GROUP BY kind, chosen_id, rejected_id),
cut AS (
  SELECT s.*, coalesce(p.differ, 1000000000) AS differ,
         '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS piece
  FROM sides s LEFT JOIN prefix p USING (kind, chosen_id, rejected_id)),
placed AS (
  SELECT *, CASE WHEN k >= differ THEN sum(CASE WHEN k >= differ THEN length(piece) ELSE 0 END)
                 OVER (PARTITION BY kind, chosen_id, rejected_id, side ORDER BY k) - length(piece) END AS pos
  FROM cut)
SELECT kind, chosen_id, rejected_id,
       count(*) FILTER (WHERE side = 'c' AND k < differ) AS prompt_turns,
       coalesce(string_agg(piece, '' ORDER BY k) FILTER (WHERE side = 'c' AND k < differ), '') AS prompt,
       coalesce(string_agg(piece, '' ORDER BY k) FILTER (WHERE side = 'c' AND k >= differ), '') AS chosen,
       coalesce(string_agg(piece, '' ORDER BY k) FILTER (WHERE side = 'r' AND k >= differ), '') AS rejected,
       coalesce(string_agg(CAST(CAST(pos + length(role) + 5 AS BIGINT) AS VARCHAR) || '-'
                           || CAST(CAST(pos + length(piece) - 1 AS BIGINT) AS VARCHAR), ',' ORDER BY k)
                FILTER (WHERE side = 'c' AND k >= differ AND role = 'assistant'), '') AS chosen_spans,
       coalesce(string_agg(CAST(CAST(pos + length(role) + 5 AS BIGINT) AS VARCHAR) || '-'
                           || CAST(CAST(pos + length(piece) - 1 AS BIGINT) AS VARCHAR), ',' ORDER BY k)
                FILTER (WHERE side = 'r' AND k >= differ AND role = 'assistant'), '') AS rejected_spans
FROM placed GROUP BY kind, chosen_id, rejected_id
""",
    "op13_sharding": f"""
WITH d AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS id, coalesce('=' || source, 'null') AS s,
         CAST(strlen(coalesce(text, '')) + 16 AS BIGINT) AS size,
         CAST({_crc32_sql("coalesce(text, '')")} AS BIGINT) AS text_crc32
  FROM documents),
c AS (
  SELECT *, row_number() OVER (PARTITION BY id, s, size, text_crc32) - 1 AS copy FROM d),
o AS (
  SELECT *, {_md5_sql("concat_ws(':', '13', id, s, size, text_crc32, copy)")} AS o FROM c),
r AS (
  SELECT *, row_number() OVER (PARTITION BY s ORDER BY o, id, size, text_crc32, copy) - 1 AS before,
         count(*) OVER (PARTITION BY s) AS n,
         CAST({_md5_sql("concat_ws(':', '13', s)")} AS DOUBLE) / CAST(1152921504606846976 AS DOUBLE) AS u
  FROM o),
p AS (
  SELECT *, row_number() OVER (ORDER BY (before + 1 - u) / n, s, before) - 1 AS place, count(*) OVER () AS total FROM r),
q AS (
  SELECT *, place * 40 // total AS shard FROM p)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(place - (shard * total + 39) // 40 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM q
""",
}
