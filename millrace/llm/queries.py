"""Registered queries of the training-data operators (whole tables, production
parameters) and their DuckDB texts where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.lm_bloom import score_documents
    return score_documents(table(spark, sf_dir, "documents"))


def op2_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.kd_shards import shards
    return shards(table(spark, sf_dir, "documents")).withColumn("grown_shard", F.lit(None).cast("int"))


def op3_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.near_dups import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.language import fit, identify, remainder
    docs = table(spark, sf_dir, "documents")
    held = remainder(F.col("doc_id"), 3) == 1
    model = fit(docs.where(~held))
    out = identify(docs, model).withColumn("held_out", held)
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op5_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.decontaminate import leaks
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.chat_format import format_chats, read_back
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_chats(turns.unionByName(extra)))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.token_fst import count_tokens
    return count_tokens(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.token_files import token_files
    return token_files(table(spark, sf_dir, "documents"))


def op10_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.repetition import quality
    return quality(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.periodic_runs import periodic_runs
    docs = table(spark, sf_dir, "documents")
    # the contract's rewriting: from word a on, words repeat with period p
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    planted = (docs.where(h % 10 == 0).select("doc_id", F.floor(h / 10).alias("g"), F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1).alias("w"))
               .select("doc_id", "g", "w", F.size("w").alias("n")).where("n > 0")
               .selectExpr("doc_id", "g", "w", "n", "cast(g % n as int) AS a")
               .selectExpr("doc_id", "w", "n", "a", "cast(1 + (n - a) div (3 + g % 8) as int) AS p")
               .selectExpr("doc_id", "array_join(concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), "
                           "cast(ceil((n - a) / p) as int))), 1, n - a)), ' ') AS text"))
    plain = docs.where((h % 10 != 0) | h.isNull() | F.col("text").isNull() | ~F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    out = periodic_runs(planted.unionByName(plain.select("doc_id", "text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","),
                                                   r.period.cast("string"), F.lit("\n")))
    out = out.select("doc_id", "runs", "collapsed", best.alias("best"))
    return out.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.byte_codec import decode, encode
    coded = encode(table(spark, sf_dir, "documents")).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), "ids")
    return decode(coded).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.filter_audit import filter_audit
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_lm_bloom": op1_lm_bloom,
    "op2_kd_shards": op2_kd_shards,
    "op3_near_dups": op3_near_dups,
    "op4_language": op4_language,
    "op5_leaks": op5_leaks,
    "op6_packing": op6_packing,
    "op7_chat": op7_chat,
    "op8_token_counts": op8_token_counts,
    "op9_token_files": op9_token_files,
    "op10_repetition": op10_repetition,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES: dict[str, str] = {
    # formatted_chars follows from the grammar: heads, contents, escapes and turn ends
    "op7_chat": """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, n, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(n, r)),
e AS (
  SELECT *, contains(text, '</s>') OR contains(text, '<s>') OR contains(text, '[INST]') OR contains(text, '[/INST]')
         OR contains(text, '<<SYS>>') OR contains(text, '<</SYS>>') OR contains(text, '<|') AS esc FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(CASE WHEN role = 'assistant' THEN 8 ELSE 7 END + length(role) + 1 + length(text) + 4
      + CASE WHEN esc THEN 1 + length(text) - length(replace(replace(replace(text, '<', ''), '[', ''), chr(92), '')) ELSE 0 END)::BIGINT
    AS formatted_chars
FROM e GROUP BY conv_id
""",
    "op13_filter_audit": """
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
f AS (
  SELECT d.doc_id, part,
    (len(w) < 50)::INT AS a, (100 * len(list_distinct(w)) < 65 * len(w))::INT AS b,
    (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t))::INT AS c,
    regexp_matches(t, '[#$%&*|]')::INT AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), FALSE)::INT AS e FROM d),
l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT f.*, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic,
    map {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS fails FROM f LEFT JOIN l USING (doc_id)),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE toxic) AS n_toxic FROM m GROUP BY ALL),
s AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT p.x || q.x || r.x || u.x || v.x AS filter_order FROM s p, s q, s r, s u, s v
  WHERE len(list_distinct([p.x, q.x, r.x, u.x, v.x])) = 5),
st AS (SELECT filter_order, step::INT AS step, filter_order[step] AS own, string_split(filter_order[:step - 1], '') AS before
  FROM o, range(1, 6) AS k(step)),
z AS (
  SELECT part, filter_order, step, own, n, n_good, n_toxic, fails[own] = 1 AS bad, list_sum(map_values(fails)) AS total,
    len(list_filter(before, lambda y: fails[y] = 1)) > 0 AS gone FROM g, st),
y AS (
  SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (WHERE NOT bad AND NOT gone), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE bad AND NOT gone), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (WHERE bad AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE bad AND total = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(n_good) FILTER (WHERE bad AND NOT gone), 0)::BIGINT AS good_lost,
    coalesce(sum(n_toxic) FILTER (WHERE bad AND NOT gone), 0)::BIGINT AS toxic_lost FROM z GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM y
""",
}
