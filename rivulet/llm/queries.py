"""Queries of the operators over whole tables, and their SQL where SQL can
express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.llm import decontaminate, language, merkle, mixing, near_duplicates, order_minhash, preferences, prefix_trie, quality, quality_rules, repeated_bytes, repeated_passages, sharding


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op6_training_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_matches(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), matches=False,
    ).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_ecoc_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = language.held_out()
    model = language.fit(docs, F.col("doc_id").isNotNull() & ~held)
    return (language.identify(docs, model)
            .select("doc_id", held.alias("held_out"), "lang_pred", "score"))


def op7_similarity_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_fixed_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages.remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_bwt_interval_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes.remove_repeated_bytes(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = order_minhash.compare_edits(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        order_minhash.as_text(F.col("entries")).alias("fingerprint"),
        order_minhash.as_text(F.col("edited_entries")).alias("edited_fingerprint"),
        order_minhash.likeness(F.col("entries"), F.col("edited_entries")).alias("near_edited"),
        order_minhash.likeness(F.col("entries"), F.col("next_entries")).alias("near_next"))


def op9_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = preferences.conversations(_table(spark, sf_dir, "conversations"))
    out = preferences.format_pairs(preferences.pair_with_next_reply(chats))
    runs = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["n_chars"], s["loss"])), ",")
    return out.select(F.col("conv_id").alias("chosen_id"), "rejected_id", F.col("n_prompt_turns").cast("long").alias("n_prompt_turns"),
                      "prompt", "chosen", runs("chosen_mask").alias("chosen_mask"),
                      "rejected", runs("rejected_mask").alias("rejected_mask"))


def op5_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(_table(spark, sf_dir, "documents"), [1.0] * 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                         sharding.rendezvous(F.col("key"), [1.0] * 9).alias("grown_shard"))


def op3_hypergeometric_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_empirical_bayes_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_bitmap_rank_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return merkle.audit(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 0).select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest().alias("proof_sha256"), "folded_root", "verified")


def op12_zfast_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_trie.turns(_table(spark, sf_dir, "conversations"))
    c = F.col("c")
    rebuilt, convs = prefix_trie.with_shared_openings(own, c - c % 5, F.crc32(c.cast("string")) % 9, 8)
    return prefix_trie.trie(prefix_trie.named(rebuilt), convs).drop("name")


QUERIES = {
    "op12_zfast_trie": op12_zfast_trie,
    "op11_bitmap_rank_manifest": op11_bitmap_rank_manifest,
    "op13_robust_outliers": op13_robust_outliers,
    "op4_empirical_bayes_quality": op4_empirical_bayes_quality,
    "op3_hypergeometric_mix": op3_hypergeometric_mix,
    "op5_rendezvous_shards": op5_rendezvous_shards,
    "op9_preference_formatting": op9_preference_formatting,
    "op1_order_minhash": op1_order_minhash,
    "op8_bwt_interval_expansion": op8_bwt_interval_expansion,
    "op2_fixed_block_anchors": op2_fixed_block_anchors,
    "op7_similarity_sketch_dedup": op7_similarity_sketch_dedup,
    "op10_ecoc_language": op10_ecoc_language,
    "op6_training_suffix_arrays": op6_training_suffix_arrays,
}

ORACLE = {
    "op12_zfast_trie": r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id),
c AS (
  SELECT s.conv_id, s.n, b.n AS nb, s.conv_id - s.conv_id % 5 AS base,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
               list_transform(string_split(CAST(s.conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
               lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda c, i: xor(c >> 1, (c & 1) * 3988292384))), 4294967295) % 9 AS h
  FROM s LEFT JOIN s b ON b.conv_id = s.conv_id - s.conv_id % 5),
r AS (
  SELECT c.conv_id, t.k AS d, role, text FROM c JOIN t ON t.conv_id = c.base AND t.k <= c.h
  UNION ALL
  SELECT c.conv_id, least(c.h, coalesce(c.nb, 0)) + t.k - c.h, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.k > c.h),
x AS (SELECT conv_id, d, strlen(text) AS bytes,
             md5(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') OVER (
               PARTITION BY conv_id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS name FROM r),
y AS (SELECT conv_id, d, bytes, name, lag(name, 1, '') OVER (PARTITION BY conv_id ORDER BY d) AS up,
             d = max(d) OVER (PARTITION BY conv_id) AS last FROM x
      UNION ALL SELECT conv_id, 0, 0, '', NULL, conv_id NOT IN (SELECT conv_id FROM x) FROM c),
n AS (SELECT d, name, min(conv_id) AS conv, count(*) AS n_convs, max(bytes) AS bytes, max(up) AS up,
             string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE last) AS ends FROM y GROUP BY d, name),
k AS (SELECT d - 1 AS d, up AS name, count(*) AS n_children FROM n WHERE d > 0 GROUP BY d, up),
m AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k ON k.d = n.d AND k.name = n.name),
u AS (SELECT y.d, y.name, sum(CASE WHEN m.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((m.n_convs - 1) * m.bytes) AS saved_tokens
      FROM m JOIN y ON y.conv_id = m.conv AND y.d <= m.d GROUP BY y.d, y.name)
SELECT m.conv AS conv_id, CAST(m.d AS BIGINT) AS depth, p.conv AS parent_conv_id, m.n_convs, m.n_children,
       CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(m.ends, '')) AS ends_sha256
FROM m JOIN u ON u.d = m.d AND u.name = m.name LEFT JOIN m p ON p.d = m.d - 1 AND p.name = m.up
""",
    "op11_bitmap_rank_manifest": r"""
WITH RECURSIVE d AS (
  SELECT *, crc32sum % 7 = 0 AS bad FROM (
    SELECT doc_id, source, lang, n_chars, text, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
             list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
             lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda c, i: xor(c >> 1, (c & 1) * 3988292384))), 4294967295) AS crc32sum
    FROM documents)),
f AS (
  SELECT doc_id, lang, bad,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') AS front,
         coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS size,
         coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') AS size1,
         coalesce(strlen(text) || ':' || text, '-') AS rest FROM d),
l AS (SELECT doc_id, lang, sha256(front || size || rest) AS leaf,
             sha256(front || CASE WHEN bad THEN size1 ELSE size END || rest) AS seen FROM f),
p AS (SELECT *, row_number() OVER o - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n, row_number() OVER () AS rid
      FROM l WINDOW o AS (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf)),
lv AS (SELECT lang, 0 AS lvl, pos AS idx, leaf AS h, n FROM p
       UNION ALL
       SELECT lang, lvl + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (max(n) + 1) // 2 FROM lv WHERE n > 1 GROUP BY lang, lvl, idx // 2),
s AS (SELECT lang, h AS subroot, lvl AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM lv WHERE n = 1),
tv AS (SELECT 0 AS lvl, pos AS idx, subroot AS h, n FROM s
       UNION ALL
       SELECT lvl + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (max(n) + 1) // 2 FROM tv WHERE n > 1 GROUP BY lvl, idx // 2),
r AS (SELECT h AS root, lvl AS height FROM tv WHERE n = 1),
a AS (SELECT p.rid, x.lvl AS lvl, CASE WHEN lv.h IS NULL THEN 'N' WHEN (p.pos >> x.lvl) & 1 = 0 THEN 'R' || lv.h ELSE 'L' || lv.h END AS step
      FROM p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang JOIN (SELECT unnest(range(0, 64)) AS lvl) x ON x.lvl < s.height
      LEFT JOIN lv ON lv.lang IS NOT DISTINCT FROM p.lang AND lv.lvl = x.lvl AND lv.idx = xor(p.pos >> x.lvl, 1)
      UNION ALL
      SELECT p.rid, 100 + x.lvl, CASE WHEN tv.h IS NULL THEN 'N' WHEN (s.pos >> x.lvl) & 1 = 0 THEN 'R' || tv.h ELSE 'L' || tv.h END
      FROM p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang CROSS JOIN r JOIN (SELECT unnest(range(0, 64)) AS lvl) x ON x.lvl < r.height
      LEFT JOIN tv ON tv.lvl = x.lvl AND tv.idx = xor(s.pos >> x.lvl, 1)),
w AS (SELECT rid, list(step ORDER BY lvl) AS steps FROM a GROUP BY rid)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM (
  SELECT p.doc_id, p.leaf, s.subroot, r.root,
         sha256(coalesce(array_to_string(list_transform(w.steps, lambda x: substr(x, 2)), ''), '')) AS proof_sha256,
         list_reduce(list_prepend(p.seen, coalesce(w.steps, [])), lambda h, x: sha256(
           CASE substr(x, 1, 1) WHEN 'N' THEN h WHEN 'R' THEN h || substr(x, 2) ELSE substr(x, 2) || h END)) AS folded_root
  FROM p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang CROSS JOIN r LEFT JOIN w ON w.rid = p.rid)
""",
    "op3_hypergeometric_mix": r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS draw FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
      FROM d GROUP BY source),
f AS (SELECT *, coalesce(sum(3 * source_size) OVER o, 0) AS capped, coalesce(sum(w) OVER o, 0) AS used,
             sum(source_size) OVER () AS total, sum(w) OVER () AS weights
      FROM s WINDOW o AS (ORDER BY 3.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT min_by(CAST(total - capped AS DOUBLE) / CAST(weights - used AS DOUBLE), 3.0 * source_size / w) AS share
      FROM f WHERE w * (CAST(total - capped AS DOUBLE) / CAST(weights - used AS DOUBLE)) <= 3 * source_size),
t AS (SELECT source, source_size, CASE WHEN w * share > 3 * source_size THEN CAST(3 * source_size AS DOUBLE) ELSE w * share END AS target FROM s, l),
q AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS quota FROM t),
c AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (quota // source_size) * size
            + least(greatest(quota % source_size - before, 0), size) END AS BIGINT) AS taken
FROM c JOIN q ON c.source IS NOT DISTINCT FROM q.source
""",
    "op9_preference_formatting": r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) AS n,
                  coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, max(n) AS last FROM t WHERE role = 'assistant' GROUP BY conv_id),
r AS (SELECT l.conv_id, l.last, t.text AS reply, row_number() OVER (ORDER BY l.conv_id) - 1 AS k, count(*) OVER () AS total
      FROM l JOIN t ON t.conv_id = l.conv_id AND t.n = l.last),
p AS (SELECT a.conv_id AS a, b.conv_id AS b, a.last, a.reply = b.reply AS same,
             CASE WHEN a.reply = b.reply THEN a.last ELSE a.last - 1 END AS common,
             replace(a.reply, '<|', '< |') || '<|end|>' || chr(10) AS good, replace(b.reply, '<|', '< |') || '<|end|>' || chr(10) AS bad
      FROM r a JOIN r b ON b.k = (a.k + 1) % a.total),
h AS (SELECT p.a, string_agg('<|' || role || '|>' || chr(10) || replace(text, '<|', '< |') || '<|end|>' || chr(10), '' ORDER BY n) AS prompt
      FROM p JOIN t ON t.conv_id = p.a AND t.n <= p.common GROUP BY p.a)
SELECT p.a AS chosen_id, p.b AS rejected_id, CAST(common AS BIGINT) AS n_prompt_turns, coalesce(h.prompt, '') AS prompt,
       CASE WHEN same THEN '' ELSE '<|assistant|>' || chr(10) || good END AS chosen,
       CASE WHEN same THEN '' ELSE '14:0,' || len(good) || ':1' END AS chosen_mask,
       CASE WHEN same THEN '' ELSE '<|assistant|>' || chr(10) || bad END AS rejected,
       CASE WHEN same THEN '' ELSE '14:0,' || len(bad) || ':1' END AS rejected_mask
FROM p LEFT JOIN h ON h.a = p.a
""",
    "op8_bwt_interval_expansion": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, k, substr(h, 2000 * k + 1, 2398) AS h FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2000 + 1)) AS k FROM d)),
v AS (SELECT doc_id, 1000 * k + i AS j, md5(substr(h, 2 * i + 1, 400)) AS s
      FROM (SELECT doc_id, k, h, unnest(range(0, least(1000, len(h) // 2 - 199))) AS i FROM b WHERE len(h) >= 400)),
m AS (SELECT s FROM v GROUP BY s HAVING count(*) > 1),
x AS (SELECT DISTINCT doc_id, unnest(range(j, j + 200)) AS p FROM v JOIN m USING (s)),
r AS (SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS run FROM x),
q AS (SELECT doc_id, min(p) AS a, max(p) + 1 AS b FROM r GROUP BY doc_id, run),
g AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS f,
             row_number() OVER (PARTITION BY doc_id ORDER BY a DESC) = 1 AS last FROM q),
k AS (SELECT g.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
             string_agg(substr(h, 2 * f + 1, 2 * (a - f)) || CASE WHEN last THEN substr(h, 2 * b + 1) ELSE '' END, '' ORDER BY a) AS kept
      FROM g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, len(d.h) // 2 AS n_bytes, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, coalesce(k.n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k.kept, d.h))) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
""",
    "op2_fixed_block_anchors": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
v AS (SELECT doc_id, j, array_to_string(w[j : j + 49], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS j FROM d WHERE len(w) >= 50)),
m AS (SELECT s, min(doc_id) AS first FROM v GROUP BY s HAVING count(*) > 1),
x AS (SELECT DISTINCT doc_id, unnest(range(j, j + 50)) AS p FROM v JOIN m USING (s) WHERE m.first < v.doc_id),
t AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (SELECT t.doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY t.p) AS kept
      FROM t LEFT JOIN x ON x.doc_id = t.doc_id AND x.p = t.p WHERE x.p IS NULL GROUP BY t.doc_id)
SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(k.n_kept, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
""",
    "op7_similarity_sketch_dedup": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[j : j + 4], ' ') AS sh
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS j FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b USING (sh)
      WHERE a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id) c USING (doc_id)
""",
    "op6_training_suffix_arrays": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[j : j + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS j FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, j, k, array_to_string(w[j : j + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS j FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
m AS (SELECT doc_id, j, k, item_id FROM dw JOIN bw USING (k, s)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + k)) AS p FROM m) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
      FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
""",
}
