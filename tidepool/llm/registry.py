"""Registered queries of the training-data operators, with DuckDB SQL where SQL can express them.

Each query reads its whole table and derives the digest columns of its
contract from what its operator returns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from tidepool.llm import bpe, conversation, embedding_dedup, line_dedup, mixing, pii, quality, secret_scan, sharding, simhash, suffix_dedup, warc, whitening
from tidepool.llm.scratch import new_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_digest(docs: DataFrame) -> DataFrame:
    found = secret_scan.scan(docs.select("doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_guess", "max_cost")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_digest(_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.judge(docs, trees).drop("text")


#: The key of the registered query. Real runs pass a secret one.
PII_KEY = b"tidepool registered query"


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    replaced = pii.replace_entities(docs, PII_KEY)
    count = lambda kind: F.size(F.filter("entities", lambda e: e["kind"] == kind)).cast("long")
    counts = [count(k).alias(f"n_{k}") for k in pii.KINDS]
    return replaced.select("doc_id", F.col("n_entities").cast("long").alias("n_entities"), *counts, "text")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.drop_frequent_lines(docs, min_docs=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP4_SQL = """
WITH lines AS (
  SELECT row_id, doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT row_id, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
        FROM (SELECT row_number() OVER () AS row_id, doc_id, text FROM documents))),
frequent AS (SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT row_id) >= 10),
marked AS (SELECT row_id, doc_id, pos, line, key IN (SELECT key FROM frequent) AS gone FROM lines)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row_id, doc_id
"""


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_decode(docs, VOCABULARY)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, weights=(3, 1, 2), share=1.5, cap=2.0).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op6_digest(docs: DataFrame, from_files: bool = False) -> DataFrame:
    crc = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32")
    rows = sharding.histogram_shards(docs.select("doc_id", "text", crc), 8, from_files=from_files)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_digest(_table(spark, sf_dir, "documents"), from_files=True)


def op7_digest(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    warc.write_pages(pages, path)
    return warc.page_captures(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_digest(_table(spark, sf_dir, "pages"))


OP7_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.98)


OP9_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND list_dot_product(e, e) > 0
       AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
      AND list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, shingle=4, max_bits=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op11_damage(turns: DataFrame) -> DataFrame:
    """The contract's damage: a checksum of conversation and turn drops, empties, cuts, repeats or reroles a row."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"),
                     (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20).alias("_x")).where("_x <> 0")
    d = d.withColumn("text", F.when(F.col("_x") == 1, "").when(F.col("_x") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    d = d.withColumn("role", F.when(F.col("_x") == 4, "user").otherwise(F.col("role")))
    twice = F.explode(F.when(F.col("_x") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return d.withColumn("_twice", twice).select("conv_id", "turn", "role", "text")


def op11_digest(turns: DataFrame) -> DataFrame:
    damaged = op11_damage(turns.select("conv_id", "turn", "role", "text"))
    found = conversation.summary(damaged, conversation.repair(damaged))
    every = turns.select(F.col("conv_id").alias("_c")).distinct()
    zeros = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")} | {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return every.join(found, F.col("_c").eqNullSafe(F.col("conv_id")), "left").select(F.col("_c").alias("conv_id"), *zeros).fillna(zeros)


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_digest(_table(spark, sf_dir, "conversations"))


def _op11_sql() -> str:
    """The cheapest repair as a recursion over the rows of a conversation: the best (cost, edits, lines) by state."""
    add = lambda v, cost, edit, line="''": (f"{{'c': {v}.c + {cost}, 'e': {v}.e || '{edit}', 't': CASE WHEN {line} = '' THEN {v}.t "  # noqa: E731
                                            f"WHEN {v}.t = '' THEN {line} ELSE {v}.t || chr(10) || {line} END}}")
    best = lambda *x: f"list_sort([{', '.join(x)}])[1]"
    none = "{'c': 1000000000, 'e': '', 't': ''}"
    drop = lambda v: add(v, 2, "D")
    keep = lambda v, role: f"CASE WHEN fault IN (0, 3) AND initial = '{role}' THEN {add(v, '5 * (fault = 3)::INT', 'K', 'line')} ELSE {none} END"
    rerole = lambda v, role: (f"CASE WHEN fault IN (0, 3) THEN {add(v, '1 + 5 * (fault = 3)::INT', 'R', repr(role + ':') + ' || text')} "  # noqa: E731
                              f"ELSE {none} END")
    to_u, to_a = best("w0", "ws", "wa"), "wu"
    return f"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
crc AS (
  SELECT *, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)), lambda c, b:
    list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END))) % 20 AS x
  FROM src),
damaged AS (
  SELECT conv_id, turn, CASE WHEN x = 4 THEN 'user' ELSE role END AS role,
         CASE x WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM crc, unnest(CASE WHEN x = 3 THEN [1, 2] ELSE [1] END) WHERE x <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
rows AS (
  SELECT *, role || ':' || text AS line, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
         CASE WHEN body = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
              WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
  FROM numbered),
steps AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'e': '', 't': ''}} AS v0, {none} AS vs, {none} AS vu, {none} AS va
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, {drop('w0')}, {best(drop('ws'), keep('w0', 's'))},
         {best(drop('wu'), keep(to_u, 'u'), rerole(to_u, 'user'))}, {best(drop('wa'), keep(to_a, 'a'), rerole(to_a, 'assistant'))}
  FROM (SELECT rows.*, v0 AS w0, vs AS ws, {best('vu', *[add(v, 5, 'I', "'user:'") for v in ('v0', 'vs', 'va')])} AS wu,
               {best('va', add('vu', 5, 'I', "'assistant:'"), *[add(v, 10, 'II', "'user:' || chr(10) || 'assistant:'") for v in ('v0', 'vs')])} AS wa
        FROM steps JOIN rows ON rows.conv_id IS NOT DISTINCT FROM steps.conv_id AND rows.i = steps.i + 1)),
ends AS (
  SELECT conv_id, {best('v0', 'va', add('vu', 5, 'I', "'assistant:'"), add('vs', 10, 'II', "'user:' || chr(10) || 'assistant:'"))} AS best FROM steps
  QUALIFY i = max(i) OVER (PARTITION BY conv_id)),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, best.c::BIGINT AS cost, best.e AS audit, sha256(best.t) AS repaired_sha256
FROM ends e LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM e.conv_id
"""


OP11_SQL = _op11_sql()


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.drop_repeats(docs, length=400).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP12_SQL = """
WITH t AS (SELECT row_number() OVER () AS id, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT id, p, substr(h, 2 * p + 1, 2 * 899) AS h FROM (SELECT id, h, unnest(range(0, length(h) // 2 - 399, 500)) AS p FROM t)),
k AS (SELECT id, p + a AS a, md5_number(substr(h, 2 * a + 1, 800)) AS k FROM (SELECT id, p, h, unnest(range(length(h) // 2 - 399)) AS a FROM p)),
twice AS (SELECT k FROM k GROUP BY k HAVING count(*) > 1),
hits AS (SELECT id, a, a - lag(a) OVER (PARTITION BY id ORDER BY a) <= 400 AS goes_on FROM k WHERE k IN (SELECT k FROM twice)),
runs AS (SELECT id, a, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY a) AS run FROM hits),
spans AS (SELECT id, run, min(a) AS lo, max(a) + 400 AS hi FROM runs GROUP BY id, run),
gaps AS (SELECT id, hi AS lo, lead(lo) OVER (PARTITION BY id ORDER BY lo) AS hi FROM (SELECT id, lo, hi FROM spans UNION ALL SELECT DISTINCT id, -1, 0 FROM spans)),
kept AS (SELECT id, string_agg(substr(h, 2 * lo + 1, 2 * (coalesce(hi, length(h) // 2) - lo)), '' ORDER BY lo) AS h FROM gaps JOIN (SELECT id, h FROM t) USING (id)
         WHERE coalesce(hi, length(h) // 2) > lo GROUP BY id),
sums AS (SELECT id, sum(hi - lo) AS n_removed, count(*) AS n_spans FROM spans GROUP BY id)
SELECT doc_id, length(t.h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN t.h ELSE coalesce(kept.h, '') END)) AS kept_sha256
FROM t LEFT JOIN sums USING (id) LEFT JOIN kept USING (id)
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), components=32)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_secret_scan, op2_quality, op3_pii, op4_line_dedup, op5_mixing, op6_sharding, op7_warc,
                                    op8_simhash, op9_embeddings, op10_bpe, op11_conversations, op12_suffix_dedup, op13_whitening)}


def oracle_sql() -> dict[str, str]:
    return {"op4_line_dedup": OP4_SQL, "op7_warc": OP7_SQL, "op9_embeddings": OP9_SQL, "op11_conversations": OP11_SQL, "op12_suffix_dedup": OP12_SQL}
