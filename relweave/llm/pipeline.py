"""A corpus pipeline of five operators: each stage reads what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relweave.llm import decontam, langid, minhash, mixing, tokens
from relweave.llm.common import cleared, fresh_path, marked, stored, table
from relweave.llm.queries import tokenizer_path

#: Documents whose language is less probable than this are rejected.
LANGUAGE_SCORE = 0.5


def whole(docs: DataFrame) -> Column:
    """A row with all its columns as one, so that no name of theirs meets one of an operator's."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language: those without a letter, and those that no learned language fits with LANGUAGE_SCORE, go. The model is learned from these documents' lang."""
    found = langid.identify(docs.select(whole(docs), "text"), langid.fit(docs.select("doc_id", "text", "lang")), ["row"], out=("lang", "score"))
    return found.where((F.col("lang") != "und") & (F.col("score") >= LANGUAGE_SCORE)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (5-word shingles, similarity 0.8): that with the smallest id. Repeated rows of an id that stays are one document and stay; rows without an id link with nothing and stay."""
    gone = minhash.near_duplicates(docs.select("doc_id", "text"), 5, 80).where("not kept").select(F.col("doc_id").alias("_stage_gone"))
    return docs.join(gone, docs["doc_id"] == gone["_stage_gone"], "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.cleaned(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of its schedule: a row for each repeat of which half of the words or more are taken, at the first slot that holds some of it. Each row of docs is counted by itself, also where ids, sizes or texts are equal; documents without words are in no block and go."""
    rows = stored(docs.select(whole(docs), F.monotonically_increasing_id().alias("at")), "keyed")
    _, blocks = mixing.mix(rows.select("at", "row.doc_id", "row.text", "row.source"), key="at")
    sizes = rows.select("at", mixing.words(F.col("row.text")).alias("size"))
    passes = blocks.groupBy(F.col("row").alias("at"), "pass").agg(F.sum("n_words").alias("taken"), F.min("slot").alias("slot"))
    wanted = passes.join(sizes, "at").where("2 * taken >= size").select("at", "slot")
    return rows.join(wanted, "at").repartitionByRange("slot").sortWithinPartitions("slot").select("row.*")


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, and what a reader finds in them: doc_id, start, n_tokens, ids_crc32."""
    return tokens.written(docs, tokenizer_path(), 1)


STAGES = [
    ("language_id", language),
    ("minhash_near_dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("mix_sources", mixed),
    ("token_files", token_files),
]

#: Language models, tokenizers and sketches are beyond SQL; a test holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet in the shared folder and read again. What a stage needed goes when it is written; only the last one's result, which is lazy, leaves its tables until the session ends."""
    docs = table(spark, sf_dir, "documents")
    begun = marked(spark)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = fresh_path(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            cleared(spark, begun, path)
    return docs
