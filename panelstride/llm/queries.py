"""The registered queries: each applies its operator to whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from panelstride.llm import (
    decontamination,
    edit_counts,
    exact_dedup,
    hmm_scoring,
    imatch,
    merkle,
    mixing,
    packing,
    quality,
    ring_sharding,
    simhash_dedup,
    substring_dedup,
    token_alignment,
)
from panelstride.llm.catalog import query, table


@query("op1_exact_dedup", sql="""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.text) AS text_sha256
FROM t JOIN g USING (text)
""")
def op1_exact_dedup(spark, sf_dir):
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op2_quality_classifier")
def op2_quality_classifier(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_lm_scoring")
def op3_lm_scoring(spark, sf_dir):
    return hmm_scoring.score(table(spark, sf_dir, "documents"))


@query("op4_substring_dedup", sql=r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
win AS (
  SELECT doc_id, p, sha256(array_to_string(w[p:p + 34], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS p FROM d WHERE len(w) >= 35)),
rep AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
spans AS (SELECT doc_id, p FROM win JOIN rep USING (h)),
gone AS (
  SELECT DISTINCT doc_id, q FROM (SELECT doc_id, unnest(generate_series(p, p + 34)) AS q FROM spans)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS q FROM d WHERE len(w) > 0),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY q) AS t
  FROM words ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""")
def op4_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), k=35)


@query("op5_imatch_fingerprints", sql=r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_distinct(list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')) AS t
  FROM documents),
lex AS (
  SELECT t, CASE WHEN count(*) <= 0.02 * (SELECT count(*) FROM d) THEN 0 ELSE 2 END AS band
  FROM (SELECT unnest(t) AS t FROM d) GROUP BY t HAVING count(*) >= greatest(1.0, 0.005 * (SELECT count(*) FROM d))),
nx AS (
  SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS after,
         coalesce(lead(doc_id) OVER (ORDER BY doc_id), first_value(doc_id) OVER (ORDER BY doc_id)) AS next_id
  FROM d),
e AS (
  SELECT doc_id, next_id, text, left(text, length(text) - CAST(floor(length(text) / 4) AS BIGINT))
         || left(after, CAST(floor(length(text) / 4) AS BIGINT)) AS edited FROM nx),
texts AS (
  SELECT doc_id, 0 AS k, text AS x FROM e UNION ALL SELECT doc_id, 1, edited FROM e),
terms AS (
  SELECT doc_id, k, unnest(list_distinct(list_filter(string_split_regex(lower(x), '[^\p{L}\p{N}]+'), lambda y: y <> ''))) AS t
  FROM texts),
-- 0: inside the band, 1: rarer, 2: more common
flagged AS (SELECT doc_id, k, t, md5(t) AS h, coalesce(band, 1) AS band FROM terms LEFT JOIN lex USING (t)),
subset AS (SELECT unnest(generate_series(1, 63)) AS i),
inside AS (
  SELECT doc_id, k, i, substr(md5(string_agg(t, ' ' ORDER BY t)), 1, 4) AS entry
  FROM flagged JOIN subset ON CASE WHEN i <= 32 THEN substr(h, CAST(i AS INT), 1) = '0'
                                   ELSE substr(h, CAST(i - 32 AS INT), 2) = '00' END
  WHERE band = 0 GROUP BY doc_id, k, i),
outside AS (
  SELECT doc_id, k, CAST('0x' || substr(h, 1, 2) AS INT) % 32 + 1 AS i, substr(md5(arg_min(t, (band, h))), 1, 4) AS entry
  FROM flagged WHERE band > 0 GROUP BY doc_id, k, CAST('0x' || substr(h, 1, 2) AS INT) % 32 + 1),
member AS (
  SELECT doc_id, k, i, coalesce(inside.entry, outside.entry) AS entry
  FROM inside FULL JOIN outside USING (doc_id, k, i)),
fp AS (
  SELECT x.doc_id, x.k, list(coalesce(entry, '....') ORDER BY i) AS f
  FROM (SELECT doc_id, k, i FROM texts CROSS JOIN subset) x LEFT JOIN member USING (doc_id, k, i) GROUP BY x.doc_id, x.k),
three AS (
  SELECT e.doc_id, CAST(length(e.text) AS BIGINT) AS n_chars, sha256(e.edited) AS edited_sha256, a.f AS f, b.f AS ef, c.f AS nf
  FROM e JOIN fp a ON a.doc_id = e.doc_id AND a.k = 0 JOIN fp b ON b.doc_id = e.doc_id AND b.k = 1
  JOIN fp c ON c.doc_id = e.next_id AND c.k = 0),
counted AS (
  SELECT *, len(list_filter(list_zip(f, ef), lambda x: x[1] <> '....' OR x[2] <> '....')) AS ea,
            len(list_filter(list_zip(f, ef), lambda x: x[1] = x[2] AND x[1] <> '....')) AS eb,
            len(list_filter(list_zip(f, nf), lambda x: x[1] <> '....' OR x[2] <> '....')) AS na,
            len(list_filter(list_zip(f, nf), lambda x: x[1] = x[2] AND x[1] <> '....')) AS nb
  FROM three)
SELECT doc_id, n_chars, edited_sha256, array_to_string(f, '') AS fingerprint, array_to_string(ef, '') AS edited_fingerprint,
       CASE WHEN ea = 0 THEN 1.0 ELSE CAST(eb AS DOUBLE) / ea END AS near_edited,
       CASE WHEN na = 0 THEN 1.0 ELSE CAST(nb AS DOUBLE) / na END AS near_next
FROM counted
""")
def op5_imatch_fingerprints(spark, sf_dir):
    return imatch.edit_likeness(table(spark, sf_dir, "documents"))


@query("op6_ring_sharding")
def op6_ring_sharding(spark, sf_dir):
    found = ring_sharding.shard(table(spark, sf_dir, "documents"), shards=24)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"), "home_shard")


@query("op7_edit_token_counts")
def op7_edit_token_counts(spark, sf_dir):
    """Three edits for each document, made of its own columns: its source replaces 20
    characters behind the first third, its length goes to the front, its language to
    the end."""
    docs = table(spark, sf_dir, "documents")
    n = F.char_length(F.coalesce("text", F.lit("")))

    def edit(start, length, replacement):
        return F.struct(start.cast("long").alias("start"), F.lit(length).cast("long").alias("length"),
                        F.coalesce(replacement.cast("string"), F.lit("")).alias("replacement"))

    edits = F.array(edit(F.floor(n / 3), 20, F.col("source")),
                    edit(F.lit(0), 0, F.concat(n.cast("string"), F.lit(" "))),
                    edit(F.lit((1 << 62)), 0, F.concat(F.lit("\n"), F.col("lang"))))
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    trees = edit_counts.trees(docs, ranks, pattern, keep={"edits": edits})
    return edit_counts.apply_edits(trees, ranks, pattern).drop("text", "chars", "tokens", "pre_tokens")


@query("op8_simhash_dedup")
def op8_simhash_dedup(spark, sf_dir):
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark, sf_dir):
    return packing.best_fit_packing(table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


@query("op10_source_mixing", sql=r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS source,
         CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS n_tokens
  FROM documents),
src AS (SELECT source, CAST(sum(n_tokens) AS DOUBLE) AS t FROM d GROUP BY source),
p AS (SELECT source, t, t / (SELECT sum(t) FROM src) AS p FROM src WHERE t > 0),
-- the most repeated source is the smallest, drawn (largest / smallest) ^ (1 - x) times as often as the largest
x AS (SELECT CASE WHEN max(p) / min(p) <= 1.5 THEN 0.0 ELSE 1 - ln(1.5) / ln(max(p) / min(p)) END AS x FROM p),
w AS (SELECT source, t, pow(p, x) / sum(pow(p, x)) OVER () AS weight FROM p, x),
b AS (SELECT *, weight * max(t / weight) OVER () AS budget FROM w),
s AS (
  SELECT source, t, weight, budget, greatest(1.0, ceil(sum(budget) OVER () / 1000000.0)) AS blocks,
         CAST(ceil(budget / t - 1e-9) AS BIGINT) AS rounds FROM b
  UNION ALL SELECT source, 0.0, 0.0, 0.0, 1.0, 1 FROM src WHERE t = 0),
e AS (
  SELECT doc_id, source, n_tokens, t, weight, budget, blocks, CAST(unnest(generate_series(0, rounds - 1)) AS INT) AS epoch
  FROM d JOIN s USING (source)),
placed AS (SELECT *, md5('0:' || epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place FROM e),
run AS (
  SELECT *, epoch * t + sum(n_tokens) OVER (
    PARTITION BY source, epoch ORDER BY place, doc_id, n_tokens ROWS UNBOUNDED PRECEDING) AS done FROM placed)
SELECT doc_id, source, n_tokens, epoch, place, round(weight, 9) AS weight,
       CASE WHEN budget > 0 THEN CAST(least(floor((done - n_tokens) / (budget / blocks)), blocks - 1) AS BIGINT) ELSE 0 END AS block
FROM run WHERE done <= budget * (1 + 1e-9)
""")
def op10_source_mixing(spark, sf_dir):
    drawn = mixing.mix(table(spark, sf_dir, "documents"), max_epochs=1.5, block_tokens=1_000_000)
    return drawn.withColumn("weight", F.round("weight", 9))


@query("op11_token_alignment")
def op11_token_alignment(spark, sf_dir):
    return token_alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                 public_tokenizers.path("piece_bpe_32k.model"))


@query("op12_benchmark_decontamination", sql=r"""
WITH item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
asked AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + 9], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS p FROM item WHERE len(w) > 0)),
d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
sizes AS (SELECT DISTINCT n FROM asked),
here AS (
  SELECT rid, n, p, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p FROM d JOIN sizes ON len(w) >= n)),
found AS (SELECT rid, p, n, item_id FROM here JOIN asked USING (n, win)),
hit AS (
  SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT rid, unnest(generate_series(p, p + n - 1)) AS q FROM found) GROUP BY rid),
named AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT rid, item_id FROM found) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)
""")
def op12_benchmark_decontamination(spark, sf_dir):
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)
    return found.drop("items")


@query("op13_merkle_manifest", sql=r"""
WITH RECURSIVE
d AS (
  SELECT row_number() OVER () AS rid, doc_id, source,
         concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head,
         text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
         xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
             lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                 lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 5 = 0 AS hit
  FROM documents),
leaves AS (
  SELECT rid, doc_id, source, hit, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(low) || ':' || low, '-')) AS other FROM d),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n FROM leaves),
lv AS (
  SELECT source, 0 AS lvl, pos, n, leaf AS h FROM ranked
  UNION ALL
  SELECT source, lvl + 1, pos // 16, (any_value(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY pos))
  FROM lv WHERE n > 1 GROUP BY source, lvl, pos // 16),
src AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM lv WHERE n = 1),
top AS (
  SELECT 0 AS lvl, pos, n, subroot AS h FROM src
  UNION ALL
  SELECT lvl + 1, pos // 16, (any_value(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY pos))
  FROM top WHERE n > 1 GROUP BY lvl, pos // 16),
root AS (SELECT h AS root FROM top WHERE n = 1),
sib AS (
  SELECT a.source, a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM lv a JOIN lv b ON a.source IS NOT DISTINCT FROM b.source AND a.lvl = b.lvl AND a.pos // 16 = b.pos // 16
  WHERE a.n > 1 GROUP BY a.source, a.lvl, a.pos),
topsib AS (
  SELECT a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM top a JOIN top b ON a.lvl = b.lvl AND a.pos // 16 = b.pos // 16 WHERE a.n > 1 GROUP BY a.lvl, a.pos),
steps AS (
  SELECT rid, s.lvl AS step, l, r FROM ranked
  JOIN sib s ON s.source IS NOT DISTINCT FROM ranked.source AND s.pos = ranked.pos // CAST(pow(16, s.lvl) AS BIGINT)
  UNION ALL
  SELECT rid, 1000 + t.lvl, l, r FROM ranked JOIN src ON src.source IS NOT DISTINCT FROM ranked.source
  JOIN topsib t ON t.pos = src.pos // CAST(pow(16, t.lvl) AS BIGINT)),
way AS (SELECT rid, l, r, row_number() OVER (PARTITION BY rid ORDER BY step) AS k FROM steps),
proof AS (SELECT rid, sha256(string_agg(l || r, '' ORDER BY k)) AS proof_sha256, count(*) AS k FROM way GROUP BY rid),
fold AS (
  SELECT rid, 0 AS k, CASE WHEN hit THEN other ELSE leaf END AS h FROM leaves
  UNION ALL
  SELECT fold.rid, fold.k + 1, sha256(way.l || fold.h || way.r) FROM fold JOIN way ON way.rid = fold.rid AND way.k = fold.k + 1)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, fold.h AS folded_root,
       fold.h = root AS verified, leaves.source
FROM leaves JOIN src ON src.source IS NOT DISTINCT FROM leaves.source CROSS JOIN root
LEFT JOIN proof USING (rid) JOIN fold ON fold.rid = leaves.rid AND fold.k = coalesce(proof.k, 0)
""")
def op13_merkle_manifest(spark, sf_dir):
    """Every row's leaf, proof and folded root; rows whose id's CRC-32 5 divides are
    tampered with."""
    return merkle.manifest(table(spark, sf_dir, "documents"))
