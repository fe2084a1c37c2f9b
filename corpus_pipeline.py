"""From raw to mixed documents: five stages, each by one corpus operator.

Every stage works on all rows its predecessor kept, and is written as Parquet
and read again. All but the last return the columns of documents:

1. language_id: documents without a language (null texts, texts without a
   letter) are rejected; of the others, those whose lang is null get the
   predicted one (none if no language could be learned).
2. near_dedup: SimHash near-duplicates; the document with the smallest doc_id
   of each group stays.
3. decontaminate: documents that hold a benchmark window go.
4. secret_scan: secrets in texts are replaced by a mark, n_chars follows; no
   document goes.
5. mix: what the mix of the remaining documents takes of each;
   ``mixed_texts`` gives the mix itself, slot by slot.

Rows with null ids, repeated rows, texts of any length and empty tables pass as the operators say.
Columns beside text travel through an operator as one struct, so that no
column of the documents can clash with its results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import op1_simhash, op3_secrets, op6_decontaminate, op7_mix, op9_language
from panelkit.llm.common import saved, table


def _packed(docs: DataFrame) -> DataFrame:
    """The text, and the columns beside it as one struct."""
    return docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"))


def _unpacked(got: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of documents again, ``changed`` ones anew."""
    return got.select(*[changed.get(c, F.col(c) if c == "text" else F.col("row")[c]).alias(c) for c in columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    got = op9_language.identify(_packed(docs), op9_language.train(docs), ["text", "row"]).where("__lettered")
    found = F.when(F.col("lang_pred") != "und", F.col("lang_pred"))
    return _unpacked(got, docs.columns, lang=F.coalesce(F.col("row")["lang"], found))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op1_simhash.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op6_decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    got = op3_secrets.scan(_packed(docs), op3_secrets.train(docs), ["row"])
    length = F.length("clean").cast(docs.schema["n_chars"].dataType)
    return _unpacked(got, docs.columns, text=F.col("clean"), n_chars=F.when(F.size("spans") > 0, length).otherwise(F.col("row")["n_chars"]))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op7_mix.digest(op7_mix.mix(docs))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secret_scan", secret_scan),
    ("mix", mix),
]

#: Language models, connected components and a random field: no SQL.
ORACLE_SQL = None


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that all stages before the mix kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return STAGES[-1][1](spark, kept(spark, sf_dir), sf_dir)


def mixed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix that ``run`` counts, as text: rows (shard, slot, source, text)."""
    return op7_mix.mixed_slots(kept(spark, sf_dir))
