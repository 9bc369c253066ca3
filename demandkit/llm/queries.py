"""The queries of the text operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from demandkit.llm import cover_tree, fingerprints, language, line_quality, lm, mixing, near_dup, packing, sanitise, spelling, substrings, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(packing.pieces(table(spark, sf, "documents"), tokenizer_file()))


@query
def op3_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Every page as an archive record, read back."""
    found = warc.round_trip(table(spark, sf, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op10_superminhash(spark: SparkSession, sf: str) -> DataFrame:
    """Near duplicates of all documents on shingles of two words."""
    return near_dup.near_duplicates(table(spark, sf, "documents"), shingle=2)


@query
def op5_line_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Base rules and the verdict on lines that recur across a source."""
    return line_quality.judge(table(spark, sf, "documents")).drop("n_removed_lines")


@query
def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """The language of every document; two folds of three are learned from."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", language.held_out("doc_id", 3, 1).alias("held_out"))
    model = language.learn(docs.filter("not held_out"))
    found = language.identify(docs.select("doc_id", "text", "held_out"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "share", "n_spans", "spans")


@query
def op9_sanitise(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data of every document, and terms that disclose it."""
    return sanitise.sanitise(table(spark, sf, "documents"))


@query
def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its calibrated probability, and whether it is kept."""
    return mixing.mix(table(spark, sf, "documents")).select("rest.doc_id", "source", "lang", "topic", "n_tokens", "probability", "weight", "kept")


@query
def op6_iblt(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of all documents, their edited texts and the documents that follow them."""
    return fingerprints.fingerprints(table(spark, sf, "documents"))


@query
def op4_gru_lm(spark: SparkSession, sf: str) -> DataFrame:
    """Log probabilities of all documents; six folds of seven are learned from."""
    return lm.score(table(spark, sf, "documents"), language.held_out("doc_id", 7, 2))


@query
def op8_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the 200-byte strings that occur again."""
    return substrings.remove_repeats(table(spark, sf, "documents"))


@query
def op11_cover_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.95."""
    return cover_tree.link_embeddings(table(spark, sf, "embeddings"))


@query
def op12_spelling(spark: SparkSession, sf: str) -> DataFrame:
    """Near words, form and root of every word of the documents."""
    found = spelling.variants(spelling.count_words(table(spark, sf, "documents")))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query
def op13_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """Every embedding projected on the four leading components, whitened."""
    return whitening.whiten(table(spark, sf, "embeddings"))
