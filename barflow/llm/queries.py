"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.llm import (align, automata, bpe, chat, extract, packing, pitman_yor, rules, simhash, spelling, suffix,
                         templates, tokenstore)
from barflow.llm.common import Scratch, scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{Scratch(spark).root}/token-files"
    tokenstore.write(table(spark, sf_dir, "documents"), folder)
    return tokenstore.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op5_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_passage_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = automata.remove_passages(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    with scratch(spark) as s:
        pieces = s.table(chat.format_turns(rows), "formatted")
        bad = chat.unstable(pieces).first()
        if bad:
            raise ValueError(f"the template isn't stable: {bad}")
    return chat.digest(pieces)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return bpe.decode(ids).select(
        "doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("groups", "groups_sha256")


QUERIES = {f.__name__: f for f in (
    op1_main_text, op2_simhash, op3_token_files, op4_suffix_dedup, op5_template_decontamination, op6_packing,
    op7_passage_automata, op8_pitman_yor, op9_quality_rules, op10_chat, op11_spelling, op12_bpe, op13_align)}
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
TURNS = """
    turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL VALUES (-7, 0, 'user', '\\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\\### Assistant: </turn> ok'))"""

ORACLE_SQL: dict[str, str] = {
    "op7_passage_automata": f"""
    WITH w AS (SELECT doc_id, {WORDS} AS words FROM documents),
    windows AS (SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS said
                FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w WHERE len(words) >= 20)),
    again AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY said ORDER BY doc_id, i) AS nth FROM windows)
              WHERE nth > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS at FROM again),
    places AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS at FROM w),
    kept AS (SELECT p.doc_id, count(*) AS n, string_agg(p.word, ' ' ORDER BY p.at) AS said
             FROM places p ANTI JOIN gone g ON g.doc_id = p.doc_id AND g.at = p.at GROUP BY p.doc_id)
    SELECT w.doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(said, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)""",
    "op10_chat": f"""
    WITH {TURNS}
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(14 + length(replace(regexp_replace(role, '(\\\\|###|</turn>)', '\\\\\\1', 'g'), chr(10), '\\n'))
                    + length(regexp_replace(text, '(\\\\|###|</turn>)', '\\\\\\1', 'g'))) AS BIGINT) AS formatted_chars
    FROM turns GROUP BY conv_id""",
}
