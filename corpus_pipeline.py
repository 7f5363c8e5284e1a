"""Training corpus pipeline: a list of stages over the ``documents`` table.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and reread as the next stage's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.llm import packing, rules, simhash, suffix, templates
from barflow.llm.common import NULL_ID, row_id, scratch


#: Shorter benchmark items ("Why") stand in clean documents too; op5 reports them, the pipeline drops nothing for them.
LEAST_TOKENS = 4


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with column names that no operator uses, and the names by the old ones."""
    named = {c: f"_doc_{i}" for i, c in enumerate(docs.columns)}
    return docs.withColumnsRenamed(named), named


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned decision list rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows, named = _apart(docs)
    judged = rules.judge(rows, labels, named["doc_id"], named["text"],
                         carry=tuple(named[c] for c in docs.columns if c != "doc_id"))
    return judged.filter("kept").select(*[F.col(new).alias(old) for old, new in named.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays
    (of documents without an id one text, the one with the smallest hash), and so
    does a row that repeats its id and text."""
    rows, named = _apart(docs)
    key = F.xxhash64(F.coalesce(F.col(named["text"]), F.lit("")))
    names = rows.select(row_id(named["doc_id"]).alias("id"), key.alias("key")).distinct()
    several = names.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if several.isEmpty():
        groups = simhash.near_duplicates(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        keep = groups.select(row_id("doc_id").alias("_id")).distinct()
        return docs.withColumn("_id", row_id("doc_id")).join(keep, "_id", "left_semi").select(docs.columns)
    first = F.min(F.struct("id", "key"))
    # texts stand for the rows: groups of texts are found, then each group's first row
    prints = simhash.near_duplicates(rows.withColumn("_key", key), "_key", named["text"])
    group = prints.select(F.col("_key").alias("key"), F.col("component_id").alias("grp")).distinct()
    keep = names.join(group, "key").groupBy("grp").agg(first.alias("x")).select("x.id", "x.key")
    kept = rows.withColumn("id", row_id(named["doc_id"])).withColumn("key", key).join(keep, ["id", "key"], "left_semi")
    return kept.select(*[F.col(new).alias(old) for old, new in named.items()])


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that start earlier in the corpus;
    a character cut in two goes; documents of which nothing is left go."""
    rows, named = _apart(docs)
    kept = suffix.remove_repeats(rows, id_col=named["doc_id"], text_col=named["text"],
                                 carry=tuple(n for c, n in named.items() if c not in ("doc_id", "text")), as_text=True)
    whole = kept.withColumn(named["text"], F.col("kept"))
    whole = whole.filter((F.length(named["text"]) > 0) | (F.col("n_removed") == 0))
    whole = whole.withColumn(named["n_chars"], F.length(named["text"]).cast("long"))
    return whole.select(*[F.col(new).alias(old) for old, new in named.items()])


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item of at least ``LEAST_TOKENS`` tokens, with
    its own or other numbers and names, go; so do rows with such a document's id and text, but no other texts
    that share its id or have none."""
    rows, named = _apart(docs)
    found = templates.leaking_texts(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), named["doc_id"], named["text"],
                                    least_tokens=LEAST_TOKENS)
    bad = found.select("doc", "doc_key").distinct()
    keyed = rows.withColumn("doc", row_id(named["doc_id"])).withColumn("doc_key", templates.text_key(named["text"]))
    clean = keyed.join(bad, ["doc", "doc_key"], "left_anti")
    return clean.select(*[F.col(new).alias(old) for old, new in named.items()])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, packed into sequences."""
    return packing.pack(docs)


STAGES = [("quality rules", quality), ("simhash near-dedup", near_duplicates), ("suffix-array dedup", repeats),
          ("benchmark decontamination", decontaminated), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch(spark) as s:
        for i, (_, stage) in enumerate(STAGES):
            out = stage(spark, docs, sf_dir)
            docs = s.table(out, "stage") if i < len(STAGES) - 1 else out
    return docs
