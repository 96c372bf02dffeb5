"""The registered queries of the operators, one per operator, and their SQL.

Each applies its operator, with production parameters, to the whole table and
derives the contract's columns from the operator's output.  Only the chat
formatting can be stated in SQL; the others are tested against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlens.llm import (
    chat, covering, decontam, encode, merkle, neardup, periodic, pii, quality, sharding, substrings, tokencount, toxicity,
)
from pitchlens.llm.common import table


def op1_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 shards of near equal bytes: the second version of the slot map."""
    return sharding.shard_records(table(spark, sf_dir, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")


def op2_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality.learn_from(docs, table(spark, sf_dir, "labels"))
    return quality.judged(docs, rules).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.with_token_counts(table(spark, sf_dir, "documents"))


def op5_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op6_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


#: the planted conversation: texts that are control strings
PLANTED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op7_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")
    planted = planted.select(*[F.col(f.name).cast(f.dataType) for f in rows.schema.fields])
    return chat.digests(chat.formatted(rows.unionByName(planted)))


def op8_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``repeated``: whether the document lost bytes."""
    return substrings.removal_report(table(spark, sf_dir, "documents")).withColumn("repeated", F.col("n_removed") > 0)


def op9_shared_prefix_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encoded(table(spark, sf_dir, "documents"))


def op10_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covering.similar(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampering: where 3 divides the checksum of the id, A-Z of the text in lower case."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = merkle.leaf([*map(F.col, merkle.FIELDS[:-1]), F.translate("text", capitals, capitals.lower())])
    altered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, tampered)
    found = merkle.manifest(table(spark, sf_dir, "documents"), carry={"altered": altered})
    return found.withColumn("folded_root", merkle.folded(F.coalesce("altered", "leaf"), F.col("path"))).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("path")), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; in every tenth document, by the checksum h of its id, the words
    from a = h // 10 % n on repeat the p words from a on.  Rows without an id stay."""
    h = F.crc32(F.col("doc_id").cast("string"))
    cut = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(
        h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("words"))
    cut = cut.withColumn("n", F.size("words")).withColumn("a", (F.col("g") % F.greatest("n", F.lit(1))).cast("int"))
    rest = F.col("n") - F.col("a")
    cut = cut.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil(rest / F.col("p")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times))
    planted = F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), F.lit(1), F.col("n"))
    return cut.select("doc_id", F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("minus"), r.start.alias("start"), r.period.alias("period"))))
    line = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return found.withColumn("most", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("most.start").alias("start"),
        (-F.col("most.minus")).alias("length"), F.col("most.period").alias("period"),
        F.expr("(-1000 * most.minus) div most.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_virtual_slots, op2_decision_list, op3_near_duplicates, op4_token_counts, op5_contextual_pii,
        op6_toxic_segments, op7_chat_round_trip, op8_repeated_substrings, op9_shared_prefix_encoding,
        op10_fm_index_decontamination, op11_covering_simhash, op12_merkle_manifest, op13_periodic_runs)}


_OP7_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized AS (
    SELECT *,
        -- a backslash for each control string, plain or escaped before
        length(text) + len(regexp_extract_all(text, '</?s\\*>|\[/?INST\\*\]|<\\*\|'))
        + CASE role WHEN 'user' THEN length('[INST]  [/INST]') WHEN 'assistant' THEN length('  </s>')
          ELSE length(role) + length('<||><|end|>') END AS formatted
    FROM turns
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(formatted) AS BIGINT) AS formatted_chars
FROM sized
GROUP BY conv_id
"""


def merkle_sql(levels: int = 8, group_levels: int = 4) -> str:
    """The manifest with a table per level; groups of up to 8 ** levels rows."""
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR END"
    row = " || ".join(field.format(c) for c in merkle.FIELDS[:-1])
    steps = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    crc = (f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),"
           f" lambda c, b: xor(c >> 8, {steps.replace('xor(c, b)', 'xor(c, b) & 255')})), 4294967295)")
    ctes = [f"""leaves AS (
    SELECT doc_id, lang, sha256({row} || {field.format('text')}) AS leaf,
        CASE WHEN {crc} % 3 = 0 THEN sha256({row} || {field.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS altered
    FROM documents
)""", """ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n FROM leaves
)""", "a0 AS (SELECT lang, r, n, leaf AS h FROM ranked)"]

    def climb(t: str, depth: int) -> None:
        for k in range(depth):
            ctes.append(f"""{t}{k + 1} AS (
    SELECT lang, r // 8 AS r, (any_value(n) + 7) // 8 AS n,
        CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY r)) ELSE any_value(h) END AS h
    FROM {t}{k} GROUP BY lang, r // 8
)""")
            ctes.append(f"""{t}s{k} AS (
    SELECT lang, r, n, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
        coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
    FROM {t}{k} WINDOW w AS (PARTITION BY lang, r // 8 ORDER BY r)
)""")

    def fold(t: str, depth: int, before: str, at: str, lang: str) -> str:
        for k in range(depth):
            ctes.append(f"""{t}f{k} AS (
    SELECT p.* REPLACE (CASE WHEN s.n > 1 THEN sha256(s.lft || p.folded || s.rgt) ELSE p.folded END AS folded,
        CASE WHEN s.n > 1 THEN p.proof || s.lft || s.rgt ELSE p.proof END AS proof)
    FROM {before} p JOIN {t}s{k} s ON s.lang IS NOT DISTINCT FROM {lang} AND s.r = p.{at} // {8 ** k}
)""")
            before = f"{t}f{k}"
        return before

    climb("a", levels)
    ctes.append(f"""g0 AS (
    SELECT 0 AS lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r, count(*) OVER () AS n, h, lang AS name FROM a{levels}
)""")
    climb("g", group_levels)
    ctes.append("paths AS (SELECT doc_id, lang, leaf, r, coalesce(altered, leaf) AS folded, '' AS proof FROM ranked)")
    last = fold("a", levels, "paths", "r", "p.lang")
    ctes.append(f"grouped AS (SELECT p.*, g.r AS g, g.h AS subroot FROM {last} p JOIN g0 g ON g.name IS NOT DISTINCT FROM p.lang)")
    last = fold("g", group_levels, "grouped", "g", "0")
    return f"""WITH {', '.join(ctes)}
SELECT doc_id, leaf, subroot, root.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root.h AS verified
FROM {last}, g{group_levels} root"""


def oracle_sql() -> dict[str, str]:
    return {"op7_chat_round_trip": _OP7_SQL, "op12_merkle_manifest": merkle_sql()}
