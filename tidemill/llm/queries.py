"""One query per operator, over its whole table, with the settings it would run with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.collocations import mine_collocations
from tidemill.llm.credentials import HANDFUL, scan_secrets
from tidemill.llm.decontaminate import find_leaks
from tidemill.llm.hard_negatives import mine_hard_negatives
from tidemill.llm.language_kernel import fit_languages, identify_languages
from tidemill.llm.oracles import COLLOCATIONS, HARD_NEGATIVES
from tidemill.llm.packing import pack_documents
from tidemill.llm.pii import find_personal_data
from tidemill.llm.quality import fit_on_ratings, grade_documents, graded_labels
from tidemill.llm.simhash import simhash_components
from tidemill.llm.token_cache import count_tokens
from tidemill.llm.token_files import read_documents, write_token_files
from tidemill.llm.transcripts import parse_transcripts, raw_lines
from tidemill.llm.vector_dedup import near_vectors
from tidemill.session import pin_utc, scratch_path


def tokenizer_file(name: str) -> str:
    """Where the public tokenizer files are on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def joined_spans(spans: str, keep=None):
    """kind:start:end of an array of spans, comma-joined in its order."""
    chosen = F.filter(spans, keep) if keep else F.col(spans)
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _of_kind(spans: str, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that leak benchmark items, one row per document and item."""
    leaks = find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return leaks.select("doc_id", "item_id", F.col("n_windows").cast("long").alias("n_windows"), "n_found", "similarity")


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document; a source is an owner, its part in one language a repository."""
    docs = _table(spark, folder, "documents")
    repo = F.concat_ws("/", "source", "lang")
    found = scan_secrets(docs, repo=repo, owner=F.col("source"), most_owners=HANDFUL, examples=True)
    base = joined_spans("spans", lambda s: s["rank"] < 3)
    return found.select(
        "doc_id", *[_of_kind("spans", k) for k in ("assign", "access", "hex")], F.sha2(base, 256).alias("base_sha256"),
        joined_spans("spans").alias("spans"), F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
    )


def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 2,048 tokens."""
    packed = pack_documents(_table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"))
    return packed.withColumn("sequence_id", F.col("sequence_id").cast("long"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grades and tail probabilities of all documents."""
    docs = _table(spark, folder, "documents")
    model = fit_on_ratings(docs, graded_labels(_table(spark, folder, "labels")), n_grades=3)
    return grade_documents(docs, model).withColumnRenamed("accepted", "kept")


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of all documents through a cache that begins empty."""
    cache = scratch_path(spark, "token-counts")
    return count_tokens(_table(spark, folder, "documents"), cache, tokenizer_file("byte_bpe_50k.json")).drop("cached")


def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document."""
    found = find_personal_data(_table(spark, folder, "documents"))
    base = joined_spans("spans", lambda s: s["rank"] < 4)
    return found.select(
        "doc_id", *[_of_kind("spans", k) for k in ("email", "ip", "card", "phone")], F.sha2(base, 256).alias("base_sha256"),
        joined_spans("spans").alias("spans"), F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def op7_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """Turns recovered from the conversations' transcripts."""
    return parse_transcripts(raw_lines(_table(spark, folder, "conversations")), line_col=("turn_no", "line_no"))


def op8_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.9."""
    return near_vectors(_table(spark, folder, "embeddings"))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents at two bits of three-word fingerprints."""
    found = simhash_components(_table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' ids, written to token files and read back."""
    docs = _table(spark, folder, "documents")
    manifest = write_token_files(docs, scratch_path(spark, "token-ids"), tokenizer_file("byte_bpe_50k.json"))
    return read_documents(manifest, docs.schema["doc_id"].dataType.simpleString())


def op11_language_kernel(spark: SparkSession, folder: str) -> DataFrame:
    """The language of all documents, learnt from four fifths of them."""
    docs = _table(spark, folder, "documents")
    held_out = lambda key: F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = fit_languages(docs, learn=~held_out("doc_id"))
    found = identify_languages(docs, model)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Ten negatives for each of the five positives of every hundredth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, folder, "embeddings").withColumn("label", label)
    return mine_hard_negatives(rows, anchor=F.col("id") % 100 == 0)


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best 2,000 phrases of each language."""
    return mine_collocations(_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_secret_scan, op3_best_fit_packing, op4_quality, op5_token_counts, op6_personal_data, op7_transcripts,
        op8_near_vectors, op9_simhash, op10_token_files, op11_language_kernel, op12_hard_negatives, op13_collocations,
    )
}

# A query has its SQL where whole tables are within SQL's reach; the others are tested against brute force.
ORACLES: dict[str, str] = {"op12_hard_negatives": HARD_NEGATIVES, "op13_collocations": COLLOCATIONS}
