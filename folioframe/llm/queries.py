"""The thin queries over the operators of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm.decontaminate import contaminated
from folioframe.llm.filter_audit import audit_documents
from folioframe.llm.line_dedup import line_dedup
from folioframe.llm.near_dedup import near_duplicates
from folioframe.llm.packing import pack_documents
from folioframe.llm.pii import find_pii
from folioframe.llm.quality import score_quality
from folioframe.llm.quotations import reply_conversations
from folioframe.llm.sharding import shard_by_bytes
from folioframe.llm.spelling import count_words, group_variants
from folioframe.llm.substring_dedup import substring_dedup
from folioframe.llm.topk_search import top_k
from folioframe.llm.toxicity import score_toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH w AS (
    SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS word,
           generate_subscripts(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), 1) AS i
    FROM documents),
p AS (
    SELECT doc_id, i, word, count(*) OVER n AS n,
           md5(string_agg(word, ' ') OVER n) AS phrase
    FROM w WINDOW n AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
r AS (SELECT doc_id, i, word, n = 35 AND count(*) OVER (PARTITION BY phrase, n) > 1 AS repeated FROM p),
c AS (
    SELECT doc_id, i, word, bool_or(repeated) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
    FROM r),
g AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
           coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept
    FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN g ON g.doc_id = d.doc_id
"""


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
    FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
    SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (
    WITH RECURSIVE r(a, b) AS (
        SELECT doc_id, doc_id FROM documents UNION SELECT r.a, link.b FROM r JOIN link ON link.a = r.b)
    SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach ON reach.a = d.doc_id
"""


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), k=20)


OP2_SQL = r"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT vec_id, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM v),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.c * c.c) AS BIGINT) AS score
    FROM e q JOIN e c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0 GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_by_bytes(_table(spark, sf_dir, "documents"), shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


OP5_SQL = """
WITH RECURSIVE step AS (
    SELECT i, CAST(i AS UBIGINT) AS c, 0 AS k FROM range(256) t(i)
    UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END, k + 1 FROM step WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM step WHERE k = 8),
d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hex FROM documents),
b AS (
    SELECT doc_id, length(hex) // 2 + 1 AS size, list_transform(regexp_extract_all(hex, '..'),
        lambda x: CAST(instr('0123456789ABCDEF', x[1]) * 16 + instr('0123456789ABCDEF', x[2]) - 17 AS UBIGINT)) AS raw FROM d),
c AS (
    SELECT doc_id, size, xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), raw),
        lambda a, x: xor(a >> 8, crc.t[CAST(xor(a & 255, x) AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT)) AS text_crc32 FROM b, crc),
r AS (SELECT *, sum(size) OVER (ORDER BY doc_id) - size AS before, sum(size) OVER () AS total FROM c),
s AS (SELECT *, CAST(before * 8 // total AS INTEGER) AS shard FROM r)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s
"""


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_pii(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), eligible="crc32(cast(id AS string)) % 5 <> 0")
    return out.select("doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).alias("held_out"), "score", "predicted")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_conversations(_table(spark, sf_dir, "conversations"))


OP10_SQL = r"""
WITH RECURSIVE m AS (
    SELECT row_number() OVER () AS id, conv_id, turn, role,
           regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g') AS text FROM conversations),
l AS (SELECT id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM m),
q AS (
    SELECT id, i, length(regexp_replace(regexp_extract(line, '^[ \t]*(?:>[ \t]?)+'), '[^>]', '', 'g')) AS level,
           regexp_replace(line, '^[ \t]*(?:>[ \t]?)+', '') AS body FROM l),
r AS (SELECT *, i - row_number() OVER (PARTITION BY id, level ORDER BY i) AS run FROM q),
b AS (SELECT id, level, min(i) AS at_line, string_agg(body, chr(10) ORDER BY i) AS body FROM r GROUP BY id, level, run),
o AS (
    SELECT q.id, coalesce(regexp_replace(string_agg(q.body, chr(10) ORDER BY q.i) FILTER (
               q.level = 0 AND NOT (coalesce(n.level, 0) > 0 AND regexp_matches(q.body,
                   '(?i)^.{0,200}(^|[^\w])(wrote|writes|écrit|schrieb|escribió|escreveu)[ \t]*:[ \t]*$'))), '^\s+|\s+$', '', 'g'), '') AS own
    FROM q LEFT JOIN q n ON n.id = q.id AND n.i = q.i + 1 GROUP BY q.id),
p AS (
    SELECT id, row_number() OVER (PARTITION BY id ORDER BY at_line) - 1 AS passage, level, body FROM b
    WHERE level > 0 AND regexp_matches(body, '\S')),
texts AS (
    SELECT id, CAST(NULL AS BIGINT) AS passage, CAST(NULL AS BIGINT) AS level, own AS body FROM o UNION ALL SELECT id, passage, level, body FROM p),
units AS (
    SELECT id, passage, level, 0 AS rank, trim(regexp_replace(lower(body), '\s+', ' ', 'g')) AS u FROM texts
    UNION ALL
    SELECT id, passage, level, 1, u FROM (
        SELECT id, passage, level, trim(regexp_replace(lower(unnest(string_split(body, chr(10)))), '\s+', ' ', 'g')) AS u FROM texts)
    WHERE len(string_split(u, ' ')) >= 4),
origin AS (
    SELECT conv_id, u, min(turn) AS origin FROM units JOIN m USING (id)
    WHERE passage IS NULL AND u <> '' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY 1, 2),
link AS (
    SELECT m.conv_id, m.turn, passage, level, arg_min(origin, (rank, origin)) AS origin
    FROM units JOIN m USING (id) JOIN origin x ON x.conv_id = m.conv_id AND x.u = units.u
    WHERE passage IS NOT NULL AND x.origin < m.turn GROUP BY 1, 2, 3, 4),
reply AS (
    SELECT conv_id, turn, arg_min(origin, (level, -origin)) AS up, count(DISTINCT passage) AS n_linked FROM link GROUP BY 1, 2),
climb AS (
    SELECT conv_id, turn, up AS root FROM reply
    UNION SELECT c.conv_id, c.turn, r.up FROM climb c JOIN reply r ON r.conv_id = c.conv_id AND r.turn = c.root),
root AS (SELECT conv_id, turn, min(root) AS root FROM climb GROUP BY 1, 2),
depth AS (SELECT id, count(*) AS n_quotes, max(level) AS quote_depth FROM p GROUP BY id)
SELECT m.conv_id, m.turn, m.role, coalesce(root.root, m.turn) AS thread, reply.up AS reply_to,
       CAST(coalesce(depth.quote_depth, 0) AS BIGINT) AS quote_depth, coalesce(depth.n_quotes, 0) AS n_quotes,
       coalesce(reply.n_linked, 0) AS n_linked, o.own AS text
FROM m JOIN o USING (id) LEFT JOIN reply ON reply.conv_id = m.conv_id AND reply.turn = m.turn
LEFT JOIN root ON root.conv_id = m.conv_id AND root.turn = m.turn LEFT JOIN depth ON depth.id = m.id
"""


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(count_words(_table(spark, sf_dir, "documents")))


OP11_SQL = r"""
WITH RECURSIVE step AS (
    SELECT i, CAST(i AS UBIGINT) AS c, 0 AS k FROM range(256) t(i)
    UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END, k + 1 FROM step WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM step WHERE k = 8),
r AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
o AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS hex FROM r GROUP BY doc_id, run),
b AS (
    SELECT run, n, list_transform(regexp_extract_all(hex, '..'),
        lambda x: CAST(instr('0123456789ABCDEF', x[1]) * 16 + instr('0123456789ABCDEF', x[2]) - 17 AS UBIGINT)) AS raw FROM o),
h AS (
    SELECT run, n, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), raw),
        lambda a, x: xor(a >> 8, crc.t[CAST(xor(a & 255, x) AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT)) AS BIGINT) AS h FROM b, crc),
s AS (SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM s WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
e AS (
    SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
d AS (SELECT DISTINCT e.word AS long, w.word AS short FROM e JOIN w ON w.word = e.head || e.tail),
near AS (
    SELECT a.word, b.word AS near, b.n FROM e a JOIN e b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
    UNION ALL SELECT long, short, n FROM d JOIN w ON w.word = short
    UNION ALL SELECT short, long, n FROM d JOIN w ON w.word = long),
best AS (SELECT word, count(*) AS n_near, max(n) AS most FROM near GROUP BY word),
pick AS (SELECT near.word, min(near.near) AS near FROM near JOIN best ON best.word = near.word AND near.n = best.most GROUP BY near.word),
f AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * w.n THEN pick.near END AS form, CASE WHEN most >= 5 * w.n THEN most END AS form_n
    FROM w LEFT JOIN best ON best.word = w.word LEFT JOIN pick ON pick.word = w.word),
up AS (SELECT word, word AS root FROM f UNION ALL SELECT up.word, f.form FROM up JOIN f ON f.word = up.root WHERE f.form IS NOT NULL),
top AS (SELECT up.word, up.root FROM up JOIN f ON f.word = up.root WHERE f.form IS NULL)
SELECT f.word, f.form, top.root, f.n, f.n_near, f.form_n FROM f JOIN top ON top.word = f.word
"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
first AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
           CAST(len(w) < 200 AS INTEGER) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INTEGER)
           + 4 * CAST(100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 3 * length(d.text) AS INTEGER)
           + 8 * CAST(regexp_matches(d.text, '[#$%&*|]') AS INTEGER) + 16 * CAST(coalesce(d.doc_id > first, false) AS INTEGER) AS fails
    FROM d JOIN first ON first.text = d.text LEFT JOIN l ON l.doc_id = d.doc_id),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY part, fails),
f AS (SELECT i, chr(65 + i) AS name, 1 << i AS bit FROM (SELECT CAST(unnest(range(5)) AS INTEGER) AS i)),
o AS (
    SELECT a.name || b.name || c.name || d.name || e.name AS filter_order FROM f a, f b, f c, f d, f e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
s AS (
    SELECT filter_order, step, f.bit,
           (SELECT coalesce(sum(g.bit), 0) FROM f g WHERE instr(substr(filter_order, 1, step - 1), g.name) > 0) AS before
    FROM (SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM o) JOIN f ON f.name = substr(filter_order, step, 1)),
r AS (
    SELECT part, filter_order, step, bit,
           sum(CASE WHEN (fails & CAST(before + bit AS INTEGER)) = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN (fails & CAST(before AS INTEGER)) = 0 AND (fails & bit) > 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN (fails & CAST(before AS INTEGER)) > 0 AND (fails & bit) > 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN fails = bit THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN (fails & CAST(before AS INTEGER)) = 0 AND (fails & bit) > 0 THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN (fails & CAST(before AS INTEGER)) = 0 AND (fails & bit) > 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH l AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (
    SELECT doc_id, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
g AS (SELECT doc_id, i, line, coalesce(doc_id <> first, false) AS gone FROM k LEFT JOIN r ON r.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM g GROUP BY doc_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_topk_search": op2_topk_search,
        "op3_quality": op3_quality,
        "op4_packing": op4_packing,
        "op5_byte_shards": op5_byte_shards,
        "op6_pii": op6_pii,
        "op7_near_dedup": op7_near_dedup,
        "op8_toxicity": op8_toxicity,
        "op9_decontamination": op9_decontamination,
        "op10_quotations": op10_quotations,
        "op11_spelling": op11_spelling,
        "op12_filter_audit": op12_filter_audit,
        "op13_line_dedup": op13_line_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": OP1_SQL,
        "op2_topk_search": OP2_SQL,
        "op5_byte_shards": OP5_SQL,
        "op7_near_dedup": OP7_SQL,
        "op10_quotations": OP10_SQL,
        "op11_spelling": OP11_SQL,
        "op12_filter_audit": OP12_SQL,
        "op13_line_dedup": OP13_SQL,
    }
