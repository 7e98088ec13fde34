"""The queries opN_<name> over the given tables, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate, jaccard, language, line_dedup, lm, merkle, mixing, prefix_trie, secrets, superminhash, text, topk, toxicity, url_filter)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ASCII_LOWER_SQL = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACES_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORDS_SQL = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"


@query("op1_url_filter", sql=rf"""
WITH parsed AS (
  SELECT page_id, {ASCII_LOWER_SQL.format("coalesce(regexp_extract(url, '://([^/?#]*)', 1), '')")} AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(h, p, verdict) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
best AS (
  SELECT host, path, arg_min({{'rule': h || p, 'verdict': verdict}}, {{'a': -length(h || p), 'b': verdict != 'block', 'c': h || p}}) AS b
  FROM (SELECT DISTINCT host, path FROM parsed) JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY host, path)
SELECT page_id, parsed.host, parsed.path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict
FROM parsed LEFT JOIN best ON parsed.host = best.host AND parsed.path = best.path
""")
def op1_url_filter(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.rule_table(spark, URL_RULES))


@query("op2_topk_search", sql="""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id != c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
""")
def op2_topk_search(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op3_benchmark_decontamination", sql=rf"""
WITH t AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(coalesce(text, ''), '[0-9]+(?:[.,][0-9]+)*|\p{{L}}+') AS tok FROM documents
  UNION ALL SELECT 'i', item_id, regexp_extract_all(coalesce(text, ''), '[0-9]+(?:[.,][0-9]+)*|\p{{L}}+') FROM benchmark),
c AS (
  SELECT *, list_transform(tok, lambda x: CASE WHEN x < ':' THEN '#' WHEN lower(x) != x THEN '@'
         WHEN x IN {decontaminate.UNITS} THEN '%' ELSE x END) AS can FROM t),
i AS (SELECT id AS item_id, tok, can, least(8, len(tok)) AS width FROM c WHERE side = 'i' AND len(tok) > 0),
iw AS (
  SELECT item_id, width, p, tok[p:p + width - 1] AS a, array_to_string(can[p:p + width - 1], ' ') AS w,
         width >= 5 AND 2 * len(list_filter(can[p:p + width - 1], lambda x: x NOT IN ('#', '@', '%'))) > width AS strong
  FROM (SELECT *, unnest(range(1, len(tok) - width + 2)) AS p FROM i)),
dw AS (
  SELECT id AS doc_id, p, width, array_to_string(can[p:p + width - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(tok) - width + 2)) AS p FROM c, (SELECT DISTINCT width FROM iw)
        WHERE side = 'd' AND len(tok) >= width AND (width > 2 OR len(tok) = width))),
h AS (
  SELECT dw.doc_id, iw.item_id, iw.p, iw.strong, iw.a, d.tok[dw.p:dw.p + iw.width - 1] AS b
  FROM dw JOIN iw ON dw.w = iw.w AND dw.width = iw.width JOIN c d ON d.side = 'd' AND d.id = dw.doc_id),
f AS (
  SELECT doc_id, item_id, count(DISTINCT p) AS n_found, count(DISTINCT p) FILTER (strong) AS strong_found FROM h
  WHERE CASE WHEN strong THEN len(list_distinct(list_zip(a, b))) = len(list_distinct(a)) ELSE a = b END GROUP BY doc_id, item_id),
n AS (SELECT item_id, count(*) AS n_windows, count(*) FILTER (strong) AS n_strong FROM iw GROUP BY item_id)
SELECT doc_id, item_id, n_windows, n_found FROM f JOIN n USING (item_id)
WHERE n_found >= 0.5 * n_windows OR (n_strong > 0 AND strong_found >= 0.5 * n_strong)
""")
def op3_benchmark_decontamination(spark, sf_dir):
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_language_id")
def op4_language_id(spark, sf_dir):
    return language.held_out_language(table(spark, sf_dir, "documents"))


@query("op5_line_dedup", sql=rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM d),
k AS (SELECT doc_id, pos, line, {ASCII_LOWER_SQL.format(f"trim(line, {SPACES_SQL})")} AS key FROM l),
common AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT doc_id, pos, line, key IN (SELECT key FROM common) AS gone FROM k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
""")
def op5_line_dedup(spark, sf_dir):
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op6_secret_scan")
def op6_secret_scan(spark, sf_dir):
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


@query("op7_lm_scoring")
def op7_lm_scoring(spark, sf_dir):
    return lm.held_out_scores(table(spark, sf_dir, "documents"))


@query("op8_source_mixing", sql=rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len({WORDS_SQL.format("text")}), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([5, 2, 1])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM d GROUP BY source),
o AS (
  SELECT *, sum(source_size) OVER () * 1.5::DOUBLE AS goal, 2.0::DOUBLE * source_size AS cap,
         row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / w, source) AS n FROM s),
f AS (
  SELECT *, (goal - coalesce(sum(cap) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o),
chosen AS (SELECT level FROM f WHERE level * w <= cap ORDER BY n LIMIT 1),
t AS (SELECT source, source_size, least(cap, w * (SELECT level FROM chosen))::DOUBLE AS target FROM o),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, round(t.target)::BIGINT AS goal,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(least(a + size, goal) - a, 0) + greatest(least(a + size, goal - source_size) - a, 0))::BIGINT AS taken
FROM p
""")
def op8_source_mixing(spark, sf_dir):
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


@query("op9_toxicity")
def op9_toxicity(spark, sf_dir):
    return toxicity.held_out_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_ngram_jaccard_join", sql=rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS_SQL.format(ASCII_LOWER_SQL.format("coalesce(text, '')"))} AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS h FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
inter AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM inter JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * c >= 85 * (na.n + nb.n - c)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, r) AS (SELECT a, a FROM edges UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.r = edges.a),
least_of AS (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(least_of.r, w.doc_id) AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN least_of ON w.doc_id = least_of.doc_id
""")
def op10_ngram_jaccard_join(spark, sf_dir):
    return jaccard.link_groups(table(spark, sf_dir, "documents"))


# crc32 (reversed polynomial 0xEDB88320) of the characters of a decimal number.
CRC32_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda a, b: xor(a >> 1, (a & 1) * 3988292384))), 4294967295)"""
FIELD_SQL = "coalesce(strlen({0}::VARCHAR) || ':' || {0}, '-')"


def leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(FIELD_SQL.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


@query("op11_merkle_manifest", sql=f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, {leaf_sql("text")} AS leaf,
         CASE WHEN {CRC32_SQL.format("coalesce(doc_id::VARCHAR, '')")} % 3 = 0 THEN {leaf_sql("({0})".format(ASCII_LOWER_SQL.format("text")))} ELSE {leaf_sql("text")} END AS claim
  FROM documents),
p AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM d),
lower_tree(tree, level, pos, digest) AS (
  SELECT tree, 0, pos, leaf FROM p
  UNION ALL
  SELECT tree, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM lower_tree) WHERE n > 1 GROUP BY tree, level, pos // 8),
heights AS (SELECT tree, max(level) AS height FROM lower_tree GROUP BY tree),
subroots AS (SELECT tree, digest FROM lower_tree JOIN heights USING (tree) WHERE level = height),
upper_tree(level, pos, digest) AS (
  SELECT 0, tree, digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS n FROM upper_tree) WHERE n > 1 GROUP BY level, pos // 8),
nodes AS (
  SELECT tree, level, pos, digest, level < height AS below FROM lower_tree JOIN heights USING (tree)
  UNION ALL SELECT -1, level, pos, digest, level < (SELECT max(level) FROM upper_tree) FROM upper_tree),
steps AS (
  SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.level = b.level AND a.pos // 8 = b.pos // 8 WHERE a.below GROUP BY ALL),
walk(id, tree, level, pos, home, digest, proof) AS (
  SELECT row_number() OVER (ORDER BY tree, pos), tree, 0, pos, tree, claim, '' FROM p
  UNION ALL
  SELECT id, CASE WHEN s.pos IS NULL THEN -1 ELSE w.tree END, CASE WHEN s.pos IS NULL THEN 0 ELSE w.level + 1 END,
         CASE WHEN s.pos IS NULL THEN home ELSE w.pos // 8 END, home,
         CASE WHEN s.pos IS NULL THEN digest ELSE sha256(before || digest || after) END, proof || coalesce(before || after, '')
  FROM walk w LEFT JOIN steps s ON w.tree = s.tree AND w.level = s.level AND w.pos = s.pos
  WHERE w.tree >= 0 OR s.pos IS NOT NULL),
ends AS (
  SELECT id, arg_max(digest, level) AS folded_root, arg_max(proof, level) AS proof FROM walk WHERE tree = -1 GROUP BY id),
root AS (SELECT arg_max(digest, level) AS root FROM upper_tree)
SELECT doc_id, leaf, subroots.digest AS subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM (SELECT *, row_number() OVER (ORDER BY tree, pos) AS id FROM p) JOIN ends USING (id) JOIN subroots USING (tree), root
""")
def op11_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    leaf = lambda body: merkle.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], body)
    tampered = F.when(text.fold_share(F.col("doc_id"), 3) == 0, text.ascii_lower(F.col("text"))).otherwise(F.col("text"))
    leaves = docs.select("lang", "doc_id", leaf(F.col("text")).alias("leaf"), leaf(tampered).alias("claim"))
    found = merkle.manifest(leaves, "lang", "doc_id", "leaf", claim="claim")
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op12_prefix_trie", sql=f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {CRC32_SQL.format("conv_id::VARCHAR")} % 9 AS h, conv_id - conv_id % 5 AS base FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 0 AS part, pos, role, text FROM c JOIN t ON t.conv_id = c.base AND pos < h
  UNION ALL SELECT c.conv_id, 1, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND pos >= h),
s AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, struct_pack(role := role, text := text) AS turn FROM r),
x AS (
  SELECT conv_id, depth, list(turn) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM s
  UNION ALL SELECT conv_id, 0, [] FROM c),
e AS (SELECT conv_id, max(depth) AS len FROM x GROUP BY conv_id),
n AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (depth = len), '') AS ends
  FROM x JOIN e USING (conv_id) GROUP BY depth, path),
k AS (SELECT *, (SELECT count(*) FROM n m WHERE m.depth = n.depth + 1 AND m.path[1:n.depth] = n.path) AS n_children FROM n)
SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children,
       count(*) FILTER (b.n_children = 0) AS n_leaves,
       sum(CASE WHEN b.depth = 0 THEN 0 ELSE (b.n_convs - 1) * strlen(b.path[-1].text) END)::BIGINT AS saved_tokens, sha256(a.ends) AS ends_sha256
FROM k a JOIN k b ON b.depth >= a.depth AND b.path[1:a.depth] = a.path LEFT JOIN k p ON p.depth = a.depth - 1 AND a.path[1:a.depth - 1] = p.path
GROUP BY a.conv_id, a.depth, p.conv_id, a.n_convs, a.n_children, a.ends
""")
def op12_prefix_trie(spark, sf_dir):
    turns, conversations = prefix_trie.shared_heads(table(spark, sf_dir, "conversations"), family=5, heads=9)
    return prefix_trie.prefix_trie(turns, conversations)


@query("op13_minhash_near_dedup", sql=rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS_SQL.format(ASCII_LOWER_SQL.format("coalesce(text, '')"))} AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')) END) AS h FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
inter AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM inter JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * c >= 85 * (na.n + nb.n - c)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, r) AS (SELECT a, a FROM edges UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.r = edges.a),
least_of AS (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(least_of.r, w.doc_id) AS component_id,
       coalesce(least_of.r, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN least_of ON w.doc_id = least_of.doc_id
""")
def op13_minhash_near_dedup(spark, sf_dir):
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)
