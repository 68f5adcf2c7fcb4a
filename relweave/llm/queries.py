"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relweave.llm import chat, decontam, embeddings, langid, merkle, minhash, mixing, pii, quality, rules, spelling, tokens, warc
from relweave.llm.common import crc_mod, table


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", crc_mod(F.col("doc_id"), 4) != 2)
    out = quality.score(docs, weights, 0.7, ["doc_id"])
    return out.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumns({c: F.round(c, 6) for c in ("score", "overlap", "question_overlap", "answer_overlap")})


def tokenizer_path() -> str:
    """The vocabulary file that op2 and the pipeline use; its place is a parameter of the operator."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.written(table(spark, sf_dir, "documents"), tokenizer_path(), 1)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))[0].drop("row").withColumn("target", F.round("target", 6))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    hard = "<|im_end|><|im_start|>assistant ok"
    more = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    return chat.digest(chat.windows(rows.unionByName(more)))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.sanitise(table(spark, sf_dir, "documents")))


def op7_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.written(table(spark, sf_dir, "pages"), 0)


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), 4, 80)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = crc_mod(F.col("doc_id"), 3) == 1
    out = langid.identify(docs, langid.fit(docs, ~held), ["doc_id"])
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    made = lambda text: merkle.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    leaves = docs.select("doc_id", "source", made(F.col("text")).alias("leaf"), F.when(crc_mod(F.col("doc_id"), 5) == 0, made(tampered)).alias("tampered"))
    rows = merkle.manifest(leaves, "source", ["doc_id"], ["doc_id", "tampered"])
    rows = rows.select("doc_id", "leaf", "subroot", "root", merkle.hashed(merkle.siblings(F.col("path"))).alias("proof_sha256"), merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents")).drop("distance")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_token_files": op2_token_files,
    "op3_mix_sources": op3_mix_sources,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_chat_format": op5_chat_format,
    "op6_pii": op6_pii,
    "op7_warc_packages": op7_warc_packages,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_language_id": op10_language_id,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_quality_rules": op12_quality_rules,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL: dict[str, str] = {
    # Runs by their words, joined with those of all documents; BM25 scores of the pairs that are held, over all their passages.
    "op1_decontamination": r"""
WITH i AS (SELECT row_number() OVER () AS item, item_id, text FROM benchmark WHERE text IS NOT NULL),
s AS (SELECT *, CASE WHEN regexp_matches(text, '(?is)^.+?\banswer\s*:') AND NOT regexp_matches(text, '(?i)^answer\s*:') THEN '(?is)^(.+?)\banswer\s*:(.*)$' WHEN contains(text, '?') THEN '(?s)^(.*\?)([^?]*)$' WHEN regexp_matches(rtrim(text, E' \t\n\r'), '(?s)[.!]\s+') THEN '(?s)^(.*[.!]\s+)(\S.*)$' END AS cut FROM i),
p AS (SELECT item, item_id, 0 AS kind, text FROM s UNION ALL
  SELECT item, item_id, 1, CASE WHEN contains(cut, 'answer') THEN regexp_extract(text, '(?is)^(.+?)\banswer\s*:(.*)$', 1) WHEN contains(cut, '?]') THEN regexp_extract(text, '(?s)^(.*\?)([^?]*)$', 1) WHEN cut IS NOT NULL THEN regexp_extract(text, '(?s)^(.*[.!]\s+)(\S.*)$', 1) ELSE text END FROM s UNION ALL
  SELECT item, item_id, 2, CASE WHEN contains(cut, 'answer') THEN regexp_extract(text, '(?is)^(.+?)\banswer\s*:(.*)$', 2) WHEN contains(cut, '?]') THEN regexp_extract(text, '(?s)^(.*\?)([^?]*)$', 2) WHEN cut IS NOT NULL THEN regexp_extract(text, '(?s)^(.*[.!]\s+)(\S.*)$', 2) ELSE '' END FROM s),
w AS (SELECT item, item_id, kind, regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM p),
g AS (SELECT DISTINCT item, kind, array_to_string(w[k:k + 4], ' ') AS g FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM w WHERE len(w) > 0)),
z AS (SELECT w.item, w.item_id, w.kind, len(w.w) AS n_words, array_to_string(w.w, ' ') AS joined, count(g.g) AS n FROM w LEFT JOIN g ON g.item = w.item AND g.kind = w.kind GROUP BY ALL),
d AS (SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents WHERE text IS NOT NULL),
f AS (SELECT doc, array_to_string(w[k:k + 4], ' ') AS g, k FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 0) + 1)) AS k FROM d)),
h AS (SELECT doc, item, kind, count(DISTINCT f.g) AS hits FROM g JOIN f ON f.g = g.g GROUP BY ALL
  UNION ALL SELECT doc, item, kind, 1 FROM z JOIN d ON n_words BETWEEN 1 AND 4 AND contains(' ' || array_to_string(d.w, ' ') || ' ', ' ' || joined || ' ')),
o AS (SELECT h.doc, h.item, max(CASE WHEN h.kind = 0 THEN hits / n ELSE 0 END) AS whole, max(CASE WHEN h.kind = 1 THEN hits / n ELSE 0 END) AS question, max(CASE WHEN h.kind = 2 THEN hits / n ELSE 0 END) AS answer FROM h JOIN z ON z.item = h.item AND z.kind = h.kind GROUP BY ALL),
c AS (SELECT o.*, q.n_words >= 5 AND question >= 0.8 AS asked, a.n_words >= 5 AND answer >= 0.8 AS told FROM o JOIN z q ON q.item = o.item AND q.kind = 1 JOIN z a ON a.item = o.item AND a.kind = 2),
k AS (SELECT *, CASE WHEN asked AND told THEN 'question and answer' WHEN asked THEN 'question' WHEN told AND question >= 0.5 THEN 'answer' WHEN whole >= 0.8 THEN 'whole' END AS kind FROM c),
e AS (SELECT item, item_id, w, len(w) AS size, greatest(ceil(log2(len(w))), 4) AS level FROM w WHERE kind = 0 AND len(w) > 0),
t AS (SELECT item, size, term, count(*) AS tf FROM (SELECT item, size, unnest(w) AS term FROM e) GROUP BY ALL),
y AS (SELECT term, ln(1 + ((SELECT count(*) FROM e) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM t GROUP BY term),
m AS (SELECT t.item, t.term, greatest(idf, 1e-6) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / (SELECT avg(size) FROM e))) AS impact FROM t JOIN y ON y.term = t.term),
n AS (SELECT item, term, impact / sum(impact) OVER (PARTITION BY item) AS impact FROM m),
l AS (SELECT item, max(size) OVER (PARTITION BY level) AS step FROM e),
u AS (SELECT k.doc, k.item, step, unnest(d.w) AS term, generate_subscripts(d.w, 1) - 1 AS place FROM k JOIN d ON d.doc = k.doc JOIN l ON l.item = k.item WHERE k.kind IS NOT NULL),
v AS (SELECT DISTINCT doc, item, term, place // step - back AS passage FROM u, (VALUES (0), (1)) b(back)),
x AS (SELECT doc, item, max(score) AS score FROM (SELECT v.doc, v.item, passage, sum(impact) AS score FROM v JOIN n ON n.item = v.item AND n.term = v.term GROUP BY ALL) GROUP BY ALL)
SELECT d.doc_id, e.item_id, round(coalesce(x.score, 0), 6) AS score, round(whole, 6) AS overlap, round(question, 6) AS question_overlap, round(answer, 6) AS answer_overlap, k.kind
FROM k JOIN d ON d.doc = k.doc JOIN e ON e.item = k.item LEFT JOIN x ON x.doc = k.doc AND x.item = k.item WHERE k.kind IS NOT NULL""",
    # What lies of each document's copies before its source's target, and the schedule's slots for the blocks that hold it.
    "op3_mix_sources": """
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS place FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (ARRAY[5, 2, 1])[(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1]::DOUBLE AS weight FROM d GROUP BY source),
fill(round, source, source_size, weight, target, stopped) AS (
  SELECT 0, source, source_size, weight, weight * (sum(source_size) OVER ()) / (sum(weight) OVER ()), false FROM s
  UNION ALL
  SELECT round + 1, source, source_size, weight,
         CASE WHEN stopped OR target > 3 * source_size THEN 3.0 * source_size
              ELSE weight * ((sum(source_size) OVER ()) - (sum(CASE WHEN stopped OR target > 3 * source_size THEN 3.0 * source_size ELSE 0 END) OVER ())) / (sum(CASE WHEN stopped OR target > 3 * source_size THEN 0 ELSE weight END) OVER ()) END,
         stopped OR target > 3 * source_size
  FROM fill WHERE round < (SELECT count(*) FROM s)),
t AS (SELECT source, source_size, target, CAST(round(target) AS BIGINT) AS goal FROM fill WHERE round = (SELECT count(*) FROM s)),
p AS (SELECT d.doc_id, d.size, d.source, t.source_size, t.target, t.goal,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS sid, sum(target) OVER (ORDER BY source IS NULL, source) / greatest(sum(target) OVER (), 1) AS hi, CAST(ceil(goal / 512) AS BIGINT) AS quota FROM t),
i AS (SELECT sid, quota, coalesce(lag(hi) OVER (ORDER BY sid), 0) AS lo, CASE WHEN sid = max(sid) OVER () THEN 1 ELSE hi END AS hi FROM c),
u AS (SELECT slot, (slot + 1) * 0.6180339887498949::DOUBLE - floor((slot + 1) * 0.6180339887498949::DOUBLE) AS u FROM range((SELECT CAST(sum(quota) AS BIGINT) FROM i)) r(slot)),
k AS (SELECT slot, sid, quota, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS rank FROM u JOIN i ON u.u >= i.lo AND u.u < i.hi),
f AS (SELECT slot, row_number() OVER (ORDER BY slot) AS n FROM k WHERE rank >= quota),
w AS (SELECT sid, rank, row_number() OVER (ORDER BY sid, rank) AS n FROM (SELECT sid, unnest(range(quota)) AS rank FROM i) q WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.sid = q.sid AND k.rank = q.rank)),
z AS (SELECT sid, rank, slot FROM k WHERE rank < quota UNION ALL SELECT sid, rank, slot FROM w JOIN f ON w.n = f.n),
y AS (SELECT p.*, c.sid, row_number() OVER () AS row FROM p JOIN c ON c.source IS NOT DISTINCT FROM p.source),
x AS (SELECT row, sid, size, goal, start + pass * source_size AS a, least(start + pass * source_size + size, goal) AS z FROM y, (VALUES (0), (1), (2)) v(pass) WHERE size > 0),
b AS (SELECT row, sid, CAST(z - a AS BIGINT) AS n, unnest(range(CAST(a // 512 AS BIGINT), CAST((z - 1) // 512 + 1 AS BIGINT))) AS rank FROM x WHERE a < z),
g AS (SELECT b.row, min(slot) AS first_slot, count(DISTINCT b.rank) AS n_blocks FROM b JOIN z ON z.sid = b.sid AND z.rank = b.rank GROUP BY b.row),
h AS (SELECT row, sum(z - a) AS taken FROM x WHERE a < z GROUP BY row)
SELECT doc_id, size, source_size, round(target, 6) AS target, CAST(coalesce(h.taken, 0) AS BIGINT) AS taken, g.first_slot, CAST(coalesce(g.n_blocks, 0) AS BIGINT) AS n_blocks
FROM y LEFT JOIN g ON g.row = y.row LEFT JOIN h ON h.row = y.row""",
    # Windows' lengths come from the same prefix sums; digests from the turns themselves.
    "op5_chat_format": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
s AS (SELECT *, 24 + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + length(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<|', '<%7C')) AS chars FROM t),
n AS (SELECT *, CAST(ceil(chars / 4) AS BIGINT) + 4 AS tokens, row_number() OVER w AS n, first_value(role) OVER w = 'system' AS led FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
p AS (SELECT *, CASE WHEN led THEN first_value(tokens) OVER w ELSE 0 END AS lead, CASE WHEN led THEN first_value(chars) OVER w ELSE 0 END AS lead_chars, led AND n = 1 AS is_lead FROM n WINDOW w AS (PARTITION BY conv_id ORDER BY n)),
o AS (SELECT *, greatest(2048 - 256 - lead, 1) AS room, greatest(greatest(2048 - 256 - lead, 1) // 4, 1) AS most FROM p),
m AS (SELECT *, NOT is_lead AND tokens > most AS is_long, CASE WHEN is_lead OR tokens > most THEN 0 ELSE tokens END AS short FROM o),
a AS (SELECT *, sum(tokens) OVER w AS everything, 2 * sum(is_long::INT) OVER w - is_long::INT AS cuts, sum(short) OVER w - short AS before FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY n)),
r AS (SELECT *, CASE WHEN NOT is_lead THEN cuts * 4294967296 + floor(before / greatest(room - most, 1)) END AS own FROM a),
q AS (SELECT *, coalesce(own, lead(own) OVER (PARTITION BY conv_id ORDER BY n), 0) AS span FROM r),
e AS (SELECT conv_id, span, max(everything) AS last, lead(span) OVER (PARTITION BY conv_id ORDER BY span) IS NOT NULL AS more FROM q GROUP BY conv_id, span),
c AS (SELECT q.conv_id, sum(chars + CASE WHEN NOT is_lead AND more AND last - everything + tokens <= 256 THEN chars ELSE 0 END) + max(lead_chars) * (count(DISTINCT q.span) - 1) AS formatted_chars FROM q JOIN e ON e.conv_id IS NOT DISTINCT FROM q.conv_id AND e.span = q.span GROUP BY q.conv_id)
SELECT n.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(any_value(c.formatted_chars) AS BIGINT) AS formatted_chars
FROM n JOIN c ON c.conv_id IS NOT DISTINCT FROM n.conv_id GROUP BY n.conv_id""",
    "op7_warc_packages": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS INT)) & 31 AS INT) + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM g""",
    "op8_embedding_near_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id, vec_id AS reached FROM v UNION SELECT r.vec_id, l.b FROM r JOIN l ON l.a = r.reached)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = c.vec_id) AS n_links, component_id, component_id = vec_id AS kept FROM (SELECT vec_id, min(reached) AS component_id FROM r GROUP BY vec_id) c""",
    "op9_minhash_near_dedup": """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
o AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
f AS (SELECT doc_id, n, i, word || ' ' || lead(word, 1) OVER z || ' ' || lead(word, 2) OVER z || ' ' || lead(word, 3) OVER z AS g FROM o WINDOW z AS (PARTITION BY doc_id ORDER BY i)),
y AS (SELECT DISTINCT doc_id, g FROM f WHERE i <= n - 3 UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM w WHERE len(w) BETWEEN 1 AND 3),
k AS (SELECT w.doc_id, count(g) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS m FROM w LEFT JOIN y ON y.doc_id = w.doc_id GROUP BY w.doc_id),
d AS (SELECT min(doc_id) AS doc_id FROM k WHERE n > 0 GROUP BY m),
x AS (SELECT y.doc_id, k.n, y.g FROM y JOIN d ON d.doc_id = y.doc_id JOIN k ON k.doc_id = y.doc_id),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
  UNION SELECT a.doc_id, b.doc_id FROM (SELECT m, min(doc_id) AS doc_id FROM k WHERE n > 0 GROUP BY m) a JOIN k b ON a.m = b.m AND b.n > 0 UNION SELECT b.doc_id, a.doc_id FROM (SELECT m, min(doc_id) AS doc_id FROM k WHERE n > 0 GROUP BY m) a JOIN k b ON a.m = b.m AND b.n > 0),
r AS (SELECT doc_id, doc_id AS reached FROM k UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached)
SELECT k.doc_id, CAST(k.n AS BIGINT) AS n_shingles, min(reached) AS component_id, min(reached) = k.doc_id AS kept FROM r JOIN k ON k.doc_id = r.doc_id GROUP BY k.doc_id, k.n""",
    # All nodes of all trees (-1: the tree of subroots), their runs, and a walk from each leaf to the root.
    "op11_merkle_manifest": r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS row, * FROM documents),
f AS (SELECT row, doc_id, source, tamper,
  concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-')) AS head,
  text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS other
  FROM (SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(unicode(x) AS BIGINT))),
    lambda c, x: list_reduce(list_prepend(xor(c, x), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda a, b: xor(a >> 1, (a & 1) * 3988292384))), 4294967295) % 5 = 0 AS tamper FROM d) q),
l AS (SELECT row, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, CASE WHEN tamper THEN sha256(head || coalesce(strlen(other) || ':' || other, '-')) END AS tampered FROM f),
r AS (SELECT *, dense_rank() OVER (ORDER BY source IS NOT NULL, source) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id IS NOT NULL, doc_id, leaf) - 1 AS place FROM l),
n(level, tree, place, node, size) AS (SELECT 0, tree, place, leaf, count(*) OVER (PARTITION BY tree) FROM r
  UNION ALL SELECT level, tree, place, node, count(*) OVER (PARTITION BY tree) FROM (SELECT level + 1 AS level, tree, place // 16 AS place, sha256(string_agg(node, '' ORDER BY n.place)) AS node FROM n WHERE size > 1 GROUP BY level, tree, n.place // 16) q),
t(level, tree, place, node, size) AS (SELECT 0, -1, tree, node, count(*) OVER () FROM n WHERE size = 1
  UNION ALL SELECT level, tree, place, node, count(*) OVER () FROM (SELECT level + 1 AS level, tree, place // 16 AS place, sha256(string_agg(node, '' ORDER BY t.place)) AS node FROM t WHERE size > 1 GROUP BY level, tree, t.place // 16) q),
a AS (SELECT * FROM n UNION ALL SELECT * FROM t),
h AS (SELECT tree, max(level) AS top FROM a GROUP BY tree),
g AS (SELECT tree, level, place // 16 AS run, array_agg(node ORDER BY place) AS nodes FROM a GROUP BY ALL),
w(row, tree, level, place, node, proof) AS (SELECT row, tree, 0, place, coalesce(tampered, leaf), '' FROM r
  UNION ALL SELECT row, CASE WHEN w.level < top THEN w.tree ELSE -1 END, CASE WHEN w.level < top THEN w.level + 1 ELSE 0 END, CASE WHEN w.level < top THEN place // 16 ELSE w.tree END,
    CASE WHEN w.level < top THEN sha256(concat(array_to_string(nodes[1:place % 16], ''), node, array_to_string(nodes[place % 16 + 2:], ''))) ELSE node END,
    CASE WHEN w.level < top THEN concat(proof, array_to_string(nodes[1:place % 16], ''), array_to_string(nodes[place % 16 + 2:], '')) ELSE proof END
  FROM w JOIN h ON h.tree = w.tree LEFT JOIN g ON g.tree = w.tree AND g.level = w.level AND g.run = w.place // 16 WHERE w.level < top OR w.tree >= 0)
SELECT r.doc_id, r.leaf, s.node AS subroot, o.node AS root, sha256(proof) AS proof_sha256, w.node AS folded_root, w.node = o.node AS verified
FROM r JOIN n s ON s.tree = r.tree AND s.size = 1 JOIN t o ON o.size = 1 JOIN w ON w.row = r.row AND w.tree = -1 JOIN h ON h.tree = -1 AND w.level = h.top""",
    # Checksums byte by byte from a table; words one edit apart have a code point less in common at one place, or one is the other with one less.
    "op13_spelling_variants": r"""
WITH RECURSIVE b AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda a, z: xor(a >> 1, (a & 1) * 3988292384))) AS t),
d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+') AS w FROM documents),
o AS (SELECT row, doc_id, word, count(*) AS n FROM (SELECT row, doc_id, unnest(w) AS word FROM d) q WHERE length(word) >= 7 GROUP BY ALL),
c AS (SELECT *, list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || word, ''), lambda x: CAST(unicode(x) AS BIGINT)) AS codes FROM o),
h AS (SELECT word, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(codes, lambda x: CASE WHEN x < 128 THEN [x] ELSE [195, x - 64] END))), lambda a, x: xor(a >> 8, t[xor(a & 255, x) + 1])), 4294967295) AS h FROM c, b),
e AS (SELECT CASE WHEN h % 31 = 0 THEN substr(word, 1, CAST(h % length(word) AS BIGINT)) || substr(word, CAST(h % length(word) AS BIGINT) + 2) ELSE word END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM e WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
x AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM v) q),
p AS (SELECT a.word AS a, b.word AS b FROM x a JOIN x b ON a.less = b.less AND a.i = b.i AND a.word <> b.word UNION SELECT x.word, v.word FROM x JOIN v ON v.word = x.less UNION SELECT v.word, x.word FROM x JOIN v ON v.word = x.less),
k AS (SELECT a, count(*) AS n_near, arg_min(b, (-v.n, b)) AS form, max(v.n) AS form_n FROM p JOIN v ON v.word = p.b GROUP BY a),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * v.n THEN form END AS form, CASE WHEN form_n >= 10 * v.n THEN form_n END AS form_n FROM v LEFT JOIN k ON k.a = v.word),
r AS (SELECT word, word AS root, form AS next FROM f UNION ALL SELECT r.word, f.word, f.form FROM r JOIN f ON f.word = r.next)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM f JOIN r ON r.word = f.word AND r.next IS NULL""",
}
