"""A corpus from documents to training sequences, in stages that each read what the last one wrote.

Defined results: the stages inherit those of their operators; rows with null or empty
texts have no language and go in the first stage; without labels nothing has a language; an empty table stays empty; further
columns of the documents are carried up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from demandkit.llm import language, mixing, near_dup, packing, sanitise
from demandkit.llm.queries import tokenizer_file
from demandkit.runtime import fresh_path, remove, scratch, settle, small_side

#: Share of the tokens that the mix keeps; targets a little flatter than the corpus.
MIX_RATE = 0.85
MIX_POWERS = {"source": 0.9, "lang": 0.9, "topic": 0.95}


def _whole(docs: DataFrame) -> Column:
    """All columns as one, so that their names meet none of an operator."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("rest")


def _back(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*(F.col(f"rest.`{c}`") for c in docs.columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: texts without letters, and texts far less likely in the
    language predicted than the texts that are labelled with it."""
    model = language.learn(docs)
    others = F.struct(F.lit(None).alias("none"), *(F.col(f"`{c}`") for c in docs.columns if c != "text"))
    found = language.identify(docs.select(others.alias("rest"), "text", F.col("lang").alias("label")), model)
    found = settle(found.select("rest", "text", "label", "lang_pred", "fit"), "languages")
    levels = F.broadcast(language.fit_levels(found, "label"))  # a row for each language
    known = found.join(levels, "lang_pred", "left").filter((F.col("lang_pred") != language.UNKNOWN) & F.coalesce(F.col("fit") >= F.col("level"), F.lit(True)))
    return known.select(*(F.col("text") if c == "text" else F.col(f"rest.`{c}`") for c in docs.columns))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8.

    Of rows with one id and equal texts, one stays as well.
    """
    groups = near_dup.near_duplicates(docs)
    kept = groups.filter("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("times"))
    kept = small_side(settle(kept.withColumnRenamed("doc_id", "id"), "kept"))
    rows = docs.select(_whole(docs), "doc_id", "text").join(kept, F.col("doc_id").eqNullSafe(F.col("id")))
    # Only rows whose id repeats can be repeated: the texts of the others need not meet.
    again = rows.filter("times > 1").dropDuplicates(["doc_id", "text"])
    return _back(rows.filter("times = 1").unionByName(again), docs)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it leave the texts; no document goes."""
    out = sanitise.sanitise(docs, with_text=True)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are kept with the probabilities that meet the target weights."""
    mixed = mixing.mix(docs, carry=docs.columns, rate=MIX_RATE, powers=MIX_POWERS)
    return _back(mixed.filter("kept"), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack(packing.pieces(docs, tokenizer_file(), cache_words=CACHE_WORDS, slice_bytes=SLICE_BYTES))


#: What a worker of the last stage remembers and handles at a time: by then Spark's heap is full.
CACHE_WORDS, SLICE_BYTES = 400_000, 1 << 20

#: Documents that move to a Python worker at a time.
BATCH_ROWS = 1000

#: What stages wrote for themselves, until their results are written: by application.
_SCRATCH: dict[str, list[str]] = {}


def _staged(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, with its tables in a folder of its own.

    A result reads those tables until it is written, so they go when the next stage begins,
    unless its documents are still read from them.
    """

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        earlier = _SCRATCH.setdefault(spark.sparkContext.applicationId, [])
        used = docs.inputFiles() if earlier else []
        for path in list(earlier):
            if not any(path.rpartition("/")[2] in file for file in used):
                remove(spark, path)
                earlier.remove(path)
        # Batches of whole texts are held several times, by Spark and by the worker.
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        with scratch(spark, "stage", keep=True) as path:
            earlier.append(path)
            return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", _staged(identify_language)),
    ("near duplicates", _staged(remove_near_duplicates)),
    ("personal data", _staged(remove_personal_data)),
    ("mixing", _staged(mix_sources)),
    ("packing", _staged(pack)),
]

#: The stages rest on trained models, signatures and random groups.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again, and goes once the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path).select(*docs.columns)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
