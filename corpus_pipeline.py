"""Corpus pipeline: language, quality, near duplicates, contamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps; run() writes each result as
Parquet in the shared folder and reads it back for the next stage. All stages but the last return the
columns of their input, whatever their names: while a document is judged, its row travels as one struct. The
last adds n_tokens, domain, rate and copies; an input column of such a name is kept with ``_input`` added.

Nulls, ties and odd rows: a document without letters (a null or empty text among them) is rejected by the
first stage; the duplicate stage and the contamination stage number the rows and judge each by its own text,
whether its doc_id is null, repeated or unique; of a group of duplicates the row with the smallest doc_id
stays (nulls last, then the smallest row number); an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import decontaminate, language, mixing, ngram_join, subword
from fleetlens.llm.store import keep


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, _doc): what judges a row, and all its columns but the text as one struct, so that no name can
    clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select("doc_id", "text", F.struct(*rest).alias("_doc"))


def _unpacked(packed: DataFrame, columns: list[str]) -> list[Column]:
    """The columns of the documents again, from their struct."""
    return [packed["text"] if c == "text" else F.col(f"_doc.`{c}`").alias(c) for c in columns]


def _numbered(docs: DataFrame) -> DataFrame:
    """(_row, text, _doc): the rows with a unique number, stored so that every pass reads the same numbers."""
    return keep(_packed(docs).drop("doc_id").withColumn("_row", F.monotonically_increasing_id()), "numbered")


def _by_row(numbered: DataFrame) -> DataFrame:
    """The texts, named by their row numbers."""
    return numbered.select(F.col("_row").alias("doc_id"), "text")


def _without(numbered: DataFrame, rejected: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose number is not in ``rejected``."""
    gone = keep(rejected.select(F.col("_row").alias("_gone")), "rejected")
    left = numbered.join(gone, F.col("_row") == F.col("_gone"), "left_anti")
    return left.select(*_unpacked(left, columns))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: rejects texts without letters and those between two languages."""
    judged = language.identify(_packed(docs), language.learn(docs))
    kept = judged.where("lang_pred <> 'und' and not ambiguous")
    return kept.select(*_unpacked(kept, docs.columns))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: rejects texts that are predicted bad."""
    judged = subword.score_quality(_packed(docs), subword.learn_quality(docs, _labels(spark, sf_dir)))
    kept = judged.where("predicted = 1")
    return kept.select(*_unpacked(kept, docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2 with five words and a similarity of 0.8: the row with the smallest doc_id of a group stays."""
    numbered = _numbered(docs)
    found = ngram_join.ngram_join(_by_row(numbered), size=5, percent=80).where("n_shingles > 0")
    placed = found.select(F.col("doc_id").alias("_row"), "component_id")
    placed = keep(placed.join(numbered.select("_row", "_doc.doc_id"), "_row"), "placed")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    stay = placed.groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first._row").alias("_row"))
    return _without(numbered, placed.join(stay, "_row", "left_anti"), docs.columns)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: rejects documents that hold benchmark passages."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    numbered = _numbered(docs)
    found = decontaminate.decontaminate(_by_row(numbered), items).where("contaminated")
    return _without(numbered, found.select(F.col("doc_id").alias("_row")), docs.columns)


ADDED = ["n_tokens", "domain", "rate", "copies"]


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: the rate, and whole copies, at which each document enters the training mix."""
    model = mixing.learn_domains(docs, _labels(spark, sf_dir))
    found = mixing.mix(_packed(docs), model)
    own = [x.alias(f"{c}_input") if c in ADDED else x for c, x in zip(docs.columns, _unpacked(found, docs.columns))]
    return found.select(*own, *ADDED)


STAGES = [
    ("language ID", known_language),
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", uncontaminated),
    ("mixing sources to target weights", mixed),
]

#: Trained classifiers are no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = keep(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
