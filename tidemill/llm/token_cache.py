"""Token counts through a cache keyed by content digest and tokenizer digest.

Counting is a join: documents meet stored counts by the SHA-256 of their normalised content
and the digest of the tokenizer's file and library version.  Only distinct contents without a
stored count are encoded, each once, and their counts are appended to the cache.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from importlib.metadata import version

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.rows import map_rows, texts
from tidemill.llm.tokens import encoder
from tidemill.session import materialize, path_exists

CACHE = "digest binary, n_tokens bigint, tokenizer string"


def tokenizer_digest(path: str) -> str:
    """Changes with the file and with the library that reads it."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as file:
        return hashlib.sha256(f"{library} {version(library)} ".encode() + file.read()).hexdigest()


def stored_counts(spark, cache_path: str, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer, each digest once; no rows where the cache is not there yet."""
    if not path_exists(spark, cache_path):
        return spark.createDataFrame([], "digest binary, n_tokens bigint")
    rows = spark.read.schema(CACHE).parquet(cache_path).filter(F.col("tokenizer") == tokenizer)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame,
    cache_path: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 512,
    normalise: Callable[[Column], Column] = lambda text: text,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, cached): one row per input row.

    ``normalise`` maps a text to the content that is counted; the default keeps it, since any
    change could change the count.  A NULL text is empty and has zero tokens; repeated rows and copies share one
    encoding; NULL and repeated ids are kept as they are; an empty table gives no rows and leaves the cache
    alone.  ``cached`` tells whether the count was there before this call.  Texts move once, one
    per distinct content and map task; what follows moves digests only.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer_digest(tokenizer_path)
    plain = texts(docs, id_col, text_col)
    content = plain.withColumn("content", normalise(F.col("text"))).withColumn("digest", F.unhex(F.sha2("content", 256)))
    marked = materialize(content.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest"))
    known = materialize(stored_counts(spark, cache_path, tokenizer))
    missing = content.groupBy("digest").agg(F.first("content").alias("content")).join(known, "digest", "left_anti")

    def start():
        encode = encoder(tokenizer_path)
        return lambda rows: [(d, len(encode.ids(c)) // 4) for d, c in rows]

    fresh = map_rows(missing, [("digest", "binary"), ("n_tokens", "bigint")], start)
    fresh = fresh.withColumn("tokenizer", F.lit(tokenizer))
    fresh.write.mode("append").partitionBy("tokenizer").parquet(cache_path)
    counts = stored_counts(spark, cache_path, tokenizer).join(known.select("digest", F.lit(True).alias("cached")), "digest", "left")
    joined = marked.join(materialize(counts), "digest")
    over = F.col("n_tokens") > limit
    return joined.select("doc_id", "n_bytes", "n_tokens", over.alias("over_limit"), F.coalesce("cached", F.lit(False)).alias("cached"))
