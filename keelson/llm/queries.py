"""The registered queries of this subpackage and, where SQL can express them, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cleaning, decontaminate, importance, license_scan, line_dedup, ngram_join, packing, page_text, preference
from . import quality_cnn, sharding, substring_dedup, whitening
from .columns import utf8
from .tables import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(f):
        QUERIES[name] = f
        if oracle:
            ORACLE[name] = oracle
        return f
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP8_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM d),
g AS (SELECT rid, i, array_to_string(ws[i:i+7], ' ') AS gram
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
r AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT rid, sum(least(8, coalesce(nxt - i, 8))) AS n_repeat
      FROM (SELECT *, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM r) GROUP BY rid),
l AS (SELECT rid, x AS raw, regexp_replace(regexp_replace(x, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS x
      FROM (SELECT rid, unnest(ls) AS x FROM w)),
m AS (SELECT rid, raw, x, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n,
             len(regexp_extract_all(x, '[|»›•]')) AS bars, len(regexp_extract_all(x, '[!?]')) AS shouts,
             len(regexp_extract_all(x, '[#*$%&|<>]')) AS syms FROM l),
v AS (SELECT rid, raw,
             (bars >= 3 AND bars > n * 0.25) OR (shouts >= 3 AND shouts > n * 0.5) OR (syms >= 3 AND syms > n * 0.5)
             OR (length(x) <= 200 AND n <= 20 AND regexp_matches(x, '@BOILERPLATE@')) AS fails FROM m),
s AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (WHERE fails) AS n_failed_lines, sum(length(raw)) AS line_chars,
             coalesce(sum(length(raw)) FILTER (WHERE NOT fails), 0) AS kept_chars FROM v GROUP BY rid),
o AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_failed_lines, 0) AS BIGINT) AS n_failed_lines,
             CAST(coalesce(line_chars, 0) AS BIGINT) AS line_chars, CAST(coalesce(kept_chars, 0) AS BIGINT) AS kept_chars
      FROM w LEFT JOIN c USING (rid) LEFT JOIN s USING (rid))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND kept_chars >= line_chars * 0.5 AS kept
FROM o
""".replace("@BOILERPLATE@", cleaning.LineRules().boilerplate)


@query("op8_line_quality", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first quality rules over every document, with the counts behind the verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return cleaning.quality_report(docs).select("doc_id", "quality.*").drop("cleaned")


OP10_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents),
l AS (SELECT rid, doc_id, i, ls[i] AS line,
             translate(regexp_replace(regexp_replace(ls[i], '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM (SELECT rid, doc_id, string_split(t, chr(10)) AS ls, unnest(range(1, len(string_split(t, chr(10))) + 1)) AS i FROM d)),
h AS (SELECT k, max(doc_id) AS top FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT rid) >= 3),
m AS (SELECT l.*, h.k IS NOT NULL AND l.doc_id < h.top AS gone FROM l LEFT JOIN h USING (k))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid
"""


@query("op10_line_runs", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that three documents share go from all but the last of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs).select(
        "doc_id", "lines.n_lines", "lines.n_dropped", F.sha2(utf8(F.col("lines.kept")), 256).alias("kept_sha256"))


@query("op5_hash_ring")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document on a ring of 24 shards with bounded loads; row counts at most one apart."""
    return sharding.shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op6_best_fit")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 2048 words; neither copies nor pieces of one source
    share a sequence."""
    return packing.pack(table(spark, sf_dir, "documents"), one_per_source=True)


OP9_SQL = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i FROM t),
a AS (SELECT conv_id, max(i) AS last, row_number() OVER (ORDER BY conv_id) AS seq, count(*) OVER () AS n
      FROM k WHERE role = 'assistant' GROUP BY conv_id),
p AS (SELECT x.conv_id AS pair_id, y.conv_id AS rejected_id, x.last, y.last AS stop,
             ((x.conv_id % x.last) + x.last) % x.last AS d FROM a x JOIN a y ON y.seq = x.seq % x.n + 1),
c AS (SELECT pair_id, i, role, text FROM p JOIN k ON k.conv_id = pair_id AND k.i <= last),
r AS (SELECT pair_id, i, role, text FROM p JOIN k ON k.conv_id = pair_id AND k.i <= d
      UNION ALL SELECT pair_id, i, role, text FROM p JOIN k ON k.conv_id = rejected_id AND k.i > d AND k.i <= stop
      UNION ALL SELECT pair_id, d + 1, role, text FROM p JOIN k ON k.conv_id = rejected_id AND k.i = stop WHERE stop <= d),
m AS (SELECT pair_id, coalesce(c.i, r.i) AS i, coalesce(c.role = r.role AND c.text = r.text, false) AS same
      FROM c FULL JOIN r USING (pair_id, i)),
n AS (SELECT pair_id, coalesce(min(i) FILTER (WHERE NOT same), max(i) + 1) - 1 AS n FROM m GROUP BY pair_id),
s AS (SELECT pair_id, 'c' AS side, i, role, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS shown FROM c
      UNION ALL SELECT pair_id, 'r', i, role, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) FROM r),
e AS (SELECT s.*, n, CAST(sum(length(shown)) OVER (PARTITION BY pair_id, side, i > n ORDER BY i) AS BIGINT) AS stop_at FROM s JOIN n USING (pair_id)),
o AS (SELECT pair_id, any_value(n) AS n,
             coalesce(string_agg(shown, '' ORDER BY i) FILTER (WHERE side = 'c' AND i <= n), '') AS prompt,
             coalesce(string_agg(shown, '' ORDER BY i) FILTER (WHERE side = 'c' AND i > n), '') AS chosen_text,
             coalesce(string_agg(shown, '' ORDER BY i) FILTER (WHERE side = 'r' AND i > n), '') AS rejected_text,
             coalesce(string_agg((stop_at - length(shown) + length(role) + 5) || '-' || stop_at, ',' ORDER BY i)
                      FILTER (WHERE side = 'c' AND i > n AND role = 'assistant'), '') AS chosen_mask,
             coalesce(string_agg((stop_at - length(shown) + length(role) + 5) || '-' || stop_at, ',' ORDER BY i)
                      FILTER (WHERE side = 'r' AND i > n AND role = 'assistant'), '') AS rejected_mask
      FROM e GROUP BY pair_id)
SELECT pair_id, pair_id AS chosen_id, rejected_id, CAST(n AS INTEGER) AS n_prompt_turns, prompt, chosen_text, rejected_text,
       chosen_mask, rejected_mask
FROM o JOIN p USING (pair_id)
"""


@query("op9_preference_pairs", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation with an answer against a conversation that leaves it at some turn for the
    next one's turns."""
    pairs = preference.mismatched_pairs(preference.conversations(table(spark, sf_dir, "conversations")))
    shown = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ",")
    rows = preference.preference_rows(pairs)
    return rows.withColumns({c: shown(F.col(c)) for c in ("chosen_mask", "rejected_mask")})


OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item,
             regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
g AS (SELECT DISTINCT item, least(13, len(ws)) AS n, array_to_string(ws[i:i + least(13, len(ws)) - 1], ' ') AS gram
      FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
s AS (SELECT DISTINCT n FROM g),
w AS (SELECT rid, i, n, array_to_string(ws[i:i + n - 1], ' ') AS gram
      FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, s WHERE len(ws) >= n)),
h AS (SELECT w.rid, w.i, w.n, g.item FROM w JOIN g USING (n, gram)),
c AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT rid, i, n FROM h)) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN t USING (rid)
"""


@query("op1_decontaminate", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item: words in a window of 13, and the verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    report = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return report.select(
        "doc_id", "contamination.n_words", "contamination.n_hit",
        F.size("contamination.items").cast("long").alias("n_items"),
        F.sha2(utf8(F.array_join("contamination.items", ",")), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"))


@query("op2_partenum_join")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's set of 3-word shingles and its component at a similarity of 0.9."""
    return ngram_join.similar_groups(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS gram
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) > 1 AS again FROM g),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS k FROM f WHERE again),
k AS (SELECT doc_id, list(k) AS ks FROM c GROUP BY doc_id),
w AS (SELECT doc_id, ws[k] AS word, k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS k FROM d) LEFT JOIN c USING (doc_id, k) WHERE c.k IS NULL),
t AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS kept FROM w GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query("op7_repeated_passages", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of every document that lies in 20 words which stand earlier in the corpus goes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.without_repeats(docs).select(
        "doc_id", "substrings.n_words", "substrings.n_removed",
        F.sha2(utf8(F.col("substrings.kept")), 256).alias("kept_sha256"))


@query("op3_license_rules")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license phrases and the labels of the signature rules."""
    report = license_scan.license_report(table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts = F.transform("license.base", lambda x: x["start"])
    return report.select(
        "doc_id", "license.n_words", F.size("license.base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct(F.transform("license.base", lambda x: x["label"]))), ",").alias("base_labels"),
        F.array_join("license.labels", ",").alias("labels"), "license.score")


@query("op4_byte_cnn")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score by a network fitted on documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_cnn.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality_cnn.quality_scores(docs, model).select(
        "doc_id", quality_cnn.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


# A word's crc32 bit by bit: DuckDB has none.
OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
dw AS (SELECT rid, unnest(ws) AS w FROM d),
bw AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
v AS (SELECT DISTINCT w FROM (SELECT w FROM dw UNION ALL SELECT w FROM bw)),
h AS (SELECT w, hex(encode(w)) AS x FROM v),
y AS (SELECT w, [16 * (instr('0123456789ABCDEF', x[2 * k + 1]) - 1) + instr('0123456789ABCDEF', x[2 * k + 2]) - 1
                 FOR k IN range(0, length(x) // 2)] AS bytes FROM h),
f AS (SELECT w, xor(list_reduce(bytes, lambda c, b: list_reduce(range(0, 8),
               lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, xor(c, b)),
               CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket FROM y),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN f USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bw JOIN f USING (w) GROUP BY bucket),
z AS (SELECT coalesce((SELECT sum(n) FROM s), 0) AS s_all, coalesce((SELECT sum(n) FROM t), 0) AS t_all),
g AS (SELECT b.bucket, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE)
                                     / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS gain
      FROM (SELECT DISTINCT bucket FROM f) b LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), z),
w AS (SELECT rid, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight FROM dw JOIN f USING (w) JOIN g USING (bucket) GROUP BY rid),
o AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
             CAST(CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS DOUBLE) AS h
      FROM d LEFT JOIN w USING (rid)),
p AS (SELECT doc_id, n_features, weight,
             weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM o),
r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place,
             count(*) OVER (PARTITION BY n_features >= 20) AS n FROM p)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM r
"""


@query("op11_importance_resampling", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark's words, its noisy score and its place in a draw
    of a tenth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = importance.importance_scores(docs, table(spark, sf_dir, "benchmark")).drop("text")
    return importance.with_ranks(written(scored, "importance")).select(
        "doc_id", "importance.n_features", "importance.weight", "importance.score", "rank")


@query("op12_page_text")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text by text density."""
    return page_text.page_texts(table(spark, sf_dir, "pages")).select("page_id", "url", "main.text", "main.n_chars")


@query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector on the first eight whitened components. A deviation beyond 64 bits (tables
    of some ten million vectors) is null as a long and exact as a decimal."""
    rows = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    exact = F.col("deviation")
    return rows.select("vec_id", "component", "n", exact.try_cast("long").alias("deviation"), "whitened", "explained",
                       "identity_error", exact.alias("deviation_exact"))
