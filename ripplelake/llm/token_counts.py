"""Token counts: rollups by source, language and tokenizer version, kept by signed deltas.

A change feed holds inserts, deletes and revised counts.  Each change becomes
signed documents and tokens, a batch is summed per group before it is written,
and totals are the sum over committed batches.  A store has two tables:

* ``deltas``: (attempt, source, lang, version, n_docs, n_tokens)
* ``commits``: (batch, attempt, covers)

A batch counts from the moment its commit row exists, with the least of its
attempts; a repeated or half-written commit changes nothing.  ``compact``
reads the commits once, writes the sum of the batches in them as one attempt
and names just these in its ``covers``, so a batch that commits meanwhile is counted
beside it.  ``deltas`` is partitioned by attempt: reading a store opens the attempts
that count, and those a compaction replaced stay unread.

Scale: sums are partial in every task, so a hot source is one row a task; what
is stored and read follows groups and batches, not documents.

Defined cases: null source or language is a group; null counts are 0; changes
repeated inside a batch count as often as they occur; groups that come to no
documents and no tokens are left out; an empty batch commits nothing but its name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, text_of, words_of

GROUP = ["source", "lang", "version"]
DELTAS = "attempt string, source string, lang string, version string, n_docs long, n_tokens long"
COMMITS = "batch string, attempt string, covers array<string>"
#: Tokenizer versions of the query: runs between white space; ASCII letter and digit runs and single other characters.
RUNS = r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]"
SOLID = r"[^!-/:-@\[-`{-~]"


def signed(changes: DataFrame) -> DataFrame:
    """Signed documents and tokens per group of a feed with ``op`` (insert,
    delete, revise), GROUP, ``tokens`` and ``old_tokens`` (of a revision)."""
    tokens, old = (F.coalesce(c, F.lit(0)).cast("long") for c in ("tokens", "old_tokens"))
    docs = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).otherwise(0)
    delta = F.when(F.col("op") == "insert", tokens).when(F.col("op") == "delete", -tokens).otherwise(tokens - old)
    return changes.groupBy(*GROUP).agg(F.sum(docs).cast("long").alias("n_docs"), F.sum(delta).alias("n_tokens"))


def _read(spark: SparkSession, store: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{store}/{name}")


def create(spark: SparkSession, store: str) -> str:
    """An empty store at a new path."""
    for name, schema in (("deltas", DELTAS), ("commits", COMMITS)):
        spark.createDataFrame([], schema).write.mode("append").parquet(f"{store}/{name}")
    return store


def _write(deltas: DataFrame, store: str, batch: str | None, covers: list[str]) -> None:
    spark, attempt = deltas.sparkSession, uuid.uuid4().hex
    (deltas.select(F.lit(attempt).alias("attempt"), *GROUP, "n_docs", "n_tokens").write.mode("append")
     .partitionBy("attempt").parquet(f"{store}/deltas"))
    spark.createDataFrame([(batch, attempt, covers)], COMMITS).write.mode("append").parquet(f"{store}/commits")


def commit(changes: DataFrame, store: str, batch: str) -> bool:
    """Commit a batch; False if it was committed before."""
    known = _read(changes.sparkSession, store, "commits", COMMITS)
    if not known.filter((F.col("batch") == batch) | F.array_contains("covers", batch)).isEmpty():
        return False
    _write(signed(changes), store, batch, [])
    return True


def _active(commits: DataFrame) -> DataFrame:
    """(attempt, batch) to sum: the widest compaction and the batches it doesn't cover."""
    base = (commits.filter("batch is null").orderBy(F.size("covers").desc(), "attempt").limit(1)
            .select("attempt", "covers"))
    batches = commits.filter("batch is not null").groupBy("batch").agg(F.min("attempt").alias("attempt"))
    covered = base.select(F.explode("covers").alias("batch"))
    return batches.join(covered, "batch", "left_anti").select("attempt", "batch").union(
        base.select("attempt", F.lit(None).cast("string").alias("batch")))


def totals(spark: SparkSession, store: str) -> DataFrame:
    """source, lang, version, n_docs and n_tokens of all committed batches."""
    return _totals(spark, store, _read(spark, store, "commits", COMMITS))


def _totals(spark: SparkSession, store: str, commits: DataFrame) -> DataFrame:
    live = [r["attempt"] for r in _active(commits).select("attempt").collect()]  # batches since the last compaction
    deltas = _read(spark, store, "deltas", DELTAS).filter(F.col("attempt").isin(live))
    return (deltas.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
            .filter("n_docs <> 0 or n_tokens <> 0"))


def compact(spark: SparkSession, store: str) -> None:
    """Fold the batches that are committed now into one attempt."""
    commits = cut(_read(spark, store, "commits", COMMITS), "commits")  # one reading decides sums and names
    names = [r[0] for r in commits.select("batch").union(commits.select(F.explode("covers")))
             .filter("batch is not null").distinct().collect()]  # names of batches
    _write(cut(_totals(spark, store, commits), "compacted"), store, None, sorted(names))


def document_counts(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, words, solid words (with more than ASCII marks) and runs of every row, written once."""
    def solid(words: Column) -> Column:
        return F.size(F.filter(words, lambda w: w.rlike(SOLID)))

    rows = docs.select("doc_id", "source", "lang", text_of().alias("text")).withColumn("all", words_of(F.col("text")))
    return cut(rows.select("doc_id", "source", "lang", F.size("all").cast("long").alias("words"),
                           solid(F.col("all")).cast("long").alias("solid"),
                           F.regexp_count("text", F.lit(RUNS)).cast("long").alias("runs")), "document-counts")


def corpus_history(counts: DataFrame, labels: DataFrame, store: str) -> DataFrame:
    """Totals after three batches over all documents: a load under two
    tokenizer versions, the deletion of documents labelled 0, and a revision of the
    first version that no longer counts words of ASCII marks only.  The second is
    committed twice, and the store is compacted before the third."""
    spark = counts.sparkSession
    low = labels.filter("quality = 0").select("doc_id").distinct()

    def feed(df: DataFrame, op: str) -> DataFrame:
        both = F.array(F.struct(F.lit("words-1").alias("version"), F.col("words").alias("tokens")),
                       F.struct(F.lit("runs-1").alias("version"), F.col("runs").alias("tokens")))
        return df.select("source", "lang", F.explode(both).alias("v")).select(
            F.lit(op).alias("op"), "source", "lang", "v.version", "v.tokens", F.lit(None).cast("long").alias("old_tokens"))

    commit(feed(counts, "insert"), store, "load")
    gone = feed(counts.join(low, "doc_id", "left_semi"), "delete")
    commit(gone, store, "labels")
    commit(gone, store, "labels")
    compact(spark, store)
    left = counts.join(low, "doc_id", "left_anti").filter("solid <> words")
    commit(left.select(F.lit("revise").alias("op"), "source", "lang", F.lit("words-1").alias("version"),
                       F.col("solid").alias("tokens"), F.col("words").alias("old_tokens")), store, "solid-words")
    return totals(spark, store)
