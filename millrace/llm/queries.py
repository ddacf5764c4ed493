"""One query per operator over the supplied tables, and DuckDB equivalents where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (
    chat,
    decontam,
    infill,
    jaccard,
    language_model,
    line_dedup,
    mixing,
    periods,
    quality,
    secrets,
    token_counts,
    token_files,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"


def query(sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under its own name."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity(docs, read(spark, sf_dir, "labels").select("doc_id", "toxic")).drop("text")


@query()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path(TOKENIZER), limit=2048).drop("text")


@query()
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.taken_words(mixing.mix(docs)).drop("key")


CHAT_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), g AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    CAST(sum(length(role) + length('<|turn|><|says|><|end|>') + length(text) + length(text) - length(replace(text, chr(92), ''))
      + (length(text) - length(replace(text, '<|', ''))) // 2
      + (length(text) - length(replace(text, '</s>', ''))) // 4 + (length(text) - length(replace(text, '<s>', ''))) // 3
      + (length(text) - length(replace(text, '[INST]', ''))) // 6 + (length(text) - length(replace(text, '[/INST]', ''))) // 7
      + (length(text) - length(replace(text, '<<SYS>>', ''))) // 7 + (length(text) - length(replace(text, '<</SYS>>', ''))) // 8) AS BIGINT) AS formatted_chars
  FROM c GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""


@query(CHAT_SQL)
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    parts = turns.unionByName(more).withColumn("parts", chat.text_parts(F.col("text")))
    return chat.read_conversations(chat.format_turns(parts))


def _spans_sql(rule: secrets.Rule, place: int) -> str:
    """The spans of one rule: gaps before a match plus earlier matches give its start."""
    regex = rule.regex.replace("'", "''")
    return f"""
  SELECT r, place, kind, start, start + length(m[i]) AS stop FROM (
    SELECT r, {place} AS place, '{rule.kind}' AS kind, m, v, i,
      list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start
    FROM (SELECT r, m, v, g, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT r, regexp_extract_all(text, '{regex}') AS m, regexp_extract_all(text, '{regex}', {rule.group}) AS v,
        regexp_split_to_array(text, '{regex}') AS g FROM t)))
  WHERE length(v[i]) >= {rule.chars}"""


SECRETS_SQL = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(_spans_sql(r, i) for i, r in enumerate(secrets.RULES))}),
l AS (
  SELECT r, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access, count(*) FILTER (place = 2) AS n_hex,
    string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, place) FILTER (place < 3) AS base,
    string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, place) AS spans
  FROM s GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN l USING (r)
"""


@query(SECRETS_SQL)
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs).drop("text")
    base = [r.kind for r in secrets.BASE]

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(secrets.listed(F.filter("secrets", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        secrets.listed(F.col("secrets")).alias("spans"),
    )


DECONTAM_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), w AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS k, array_to_string(words[i:i + 9], ' ') AS gram
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)
), p AS (
  SELECT r, k, i, array_to_string(words[i:i + k - 1], ' ') AS gram
  FROM (SELECT r, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM w) WHERE len(words) >= k)
), h AS (
  SELECT r, i, p.k, item_id FROM p JOIN w ON p.k = w.k AND p.gram = w.gram
), c AS (
  SELECT r, count(DISTINCT i + j) AS n_hit FROM (SELECT r, i, unnest(range(k)) AS j FROM (SELECT DISTINCT r, i, k FROM h)) GROUP BY r
), x AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN x USING (r)
"""


@query(DECONTAM_SQL)
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.contamination(docs, read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated"
    )


JACCARD_SQL = r"""
WITH RECURSIVE t AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT r, doc_id, list_sort(list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END)) AS grams
  FROM t
), c AS (
  SELECT grams, min(r) AS k, min(doc_id) AS low, len(grams) AS n FROM s GROUP BY grams
), g AS (
  SELECT k, n, unnest(grams) AS gram FROM c
), l AS (
  SELECT a.k AS a, b.k AS b FROM g a JOIN g b ON a.gram = b.gram AND a.k <> b.k
  GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach(a, b) AS (
  SELECT k, k FROM c UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a
), m AS (
  SELECT reach.a AS k, min(c.low) AS component_id FROM reach JOIN c ON reach.b = c.k GROUP BY reach.a
)
SELECT s.doc_id, len(s.grams) AS n_shingles, CASE WHEN len(s.grams) = 0 THEN s.doc_id ELSE component_id END AS component_id
FROM s JOIN c ON s.grams = c.grams JOIN m USING (k)
"""


@query(JACCARD_SQL)
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.memberships(docs).select(F.col("doc").alias("doc_id"), "n_shingles", "component_id")


QUALITY_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM t
), g AS (
  SELECT *, [(words[i], words[i + 1], words[i + 2]) FOR i IN range(1, len(words) - 1)] AS grams FROM w
), m AS (
  SELECT row_number() OVER () AS r, * FROM g
), twice AS (
  SELECT r, list(i) AS starts FROM (
    SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n
    FROM (SELECT r, unnest(grams) AS gram, unnest(range(1, len(grams) + 1)) AS i FROM m))
  WHERE n > 1 GROUP BY r
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(starts) + k AS p FROM twice, range(3) AS x(k)) GROUP BY r
), f AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines
  FROM m LEFT JOIN covered c USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 30 * word_chars
    OR (n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines) OR word_chars > 40 * n_words OR 10 * word_chars < 15 * n_words) AS kept,
  failed_bits, sole_rule, CASE WHEN sole_rule IS NOT NULL THEN count(*) OVER (PARTITION BY sole_rule) END AS n_alone
FROM (
  SELECT *, CASE failed_bits & 63 WHEN 1 THEN 'few_words' WHEN 2 THEN 'repeated_windows' WHEN 4 THEN 'symbols'
    WHEN 8 THEN 'duplicate_lines' WHEN 16 THEN 'long_words' WHEN 32 THEN 'short_words' END AS sole_rule
  FROM (
    SELECT *, CAST(n_words < 50 AS BIGINT) + 2 * CAST(100 * n_repeat_words > 50 * n_words AS BIGINT)
      + 4 * CAST(100 * n_symbols > 30 * word_chars AS BIGINT) + 8 * CAST(n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines AS BIGINT)
      + 16 * CAST(word_chars > 40 * n_words AS BIGINT) + 32 * CAST(10 * word_chars < 15 * n_words AS BIGINT)
      + 64 * CAST(n_lines = 0 AS BIGINT) AS failed_bits
    FROM f
  )
)
"""


@query(QUALITY_SQL)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = quality.stored_ledger(docs)
    judged = quality.apply_policy(quality.with_sole_rule(ledger, quality.CURRENT), quality.CURRENT)
    return judged.select(
        "doc_id",
        *quality.MEASURES[:5],
        quality.fails(quality.BASE).alias("base_failed"),
        "kept",
        "failed_bits",
        "sole_rule",
        "n_alone",
    )


@query()
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    docs = read(spark, sf_dir, "documents")
    token_files.write_token_files(docs, path, public_tokenizers.path(TOKENIZER), end_id=1)
    return token_files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


LINES_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
  FROM documents
), k AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), many AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.*, many.key IS NOT NULL AND k.doc_id <> many.keeper AS gone FROM k LEFT JOIN many ON k.key = many.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query(LINES_SQL)
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.keep_lines(docs, line_dedup.keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


INFILL_SQL = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), d AS (
  SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS h1, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || h[25:32] AS BIGINT) % 100 AS h4 FROM t
), f AS (
  SELECT *, least(h1, h2) AS a, greatest(h1, h2) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d
), o AS (
  SELECT *, CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || substr(text, 1, a) || '<S>' || substr(text, b + 1) || '<M>' || substr(text, a + 1, b - a)
    ELSE '<S>' || substr(text, b + 1) || '<P>' || substr(text, 1, a) || '<M>' || substr(text, a + 1, b - a) END AS output FROM f
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(output) AS output_sha256, sha256(text) AS restored_sha256 FROM o
"""


@query(INFILL_SQL)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    made = infill.fill_in_middle(docs, seed="1").drop("text")
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(), 256).alias("restored_sha256"),
    )


def planted_periods(docs: DataFrame) -> DataFrame:
    """The contract's texts: in one of ten documents the words from ``a`` on repeat with period ``p``."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    chosen = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    )
    drawn = chosen.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    # The size of NULL words is NULL or -1.
    placed = drawn.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    placed = placed.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    copies = "flatten(array_repeat(slice(words, a + 1, p), cast(ceil((n - a) / p) AS int)))"
    texts = F.expr(f"array_join(concat(slice(words, 1, a), slice({copies}, 1, n - a)), ' ')")
    return placed.select("doc_id", F.when(F.col("n") > 0, texts).otherwise(F.col("text")).alias("text"))


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = planted_periods(read(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periods.periodic_runs(docs)
    strongest = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                (r["length"] / r["period"]).alias("exponent"),
                (-r["start"]).alias("start"),
                (-r["period"]).alias("period"),
                r["length"].alias("length"),
            ),
        )
    )
    listed = F.array_join(
        F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n")))), ""
    )
    best = found.withColumn("best", strongest)
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.col("collapsed_sha256"),
    )


@query()
def op13_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.language_model_scores(read(spark, sf_dir, "documents").select("doc_id", "text"))
