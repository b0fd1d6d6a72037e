"""Mixing sources to target weights by fixed-length blocks.

The words of a source, documents in order of id, are cut into blocks of
``BLOCK_WORDS``.  Targets (words per source) become numbers of slots; each
source's slots are dealt to output shards by a multinomial draw, so that a
shard's source counts are multinomial given the sources' totals; a slot takes
the block that the source's pseudorandom index permutation gives it (a Feistel
network walked until the index is in range, another key for each epoch).  Blocks
and slots are joined by (source, block index).  A block is used once an epoch
and a target is at most twice its source, so no document is taken more than
twice over.

Scale: sizes are one narrow scan; places within a source come from
``running_sum``, so a hot source spans many tasks; draws and permutations are
functions of (seed, source, slot), so a lost task makes the same rows again.
What reaches the driver is one number (the slots in all).  The source table is
small against the corpus and is broadcast below a checked number of rows.

Defined cases: null or empty text has size 0 and is never taken; a null source
is a source of its own, last in order; documents without an id and repeated
rows are documents like any other, in order of their text's hash; equal rows take
neighbouring places.  An empty table gives an empty mix.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, join_groups, n_words_of, partitions, running_sum, ship, text_of

ship(__name__)

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
BLOCK_WORDS, SHARD_BLOCKS, SEED = 64, 4096, 20240131


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, text_hash, size (words) and the row's place ``start`` among its source's words."""
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"),
                       n_words_of(text_of("text")).alias("size"))
    return cut(running_sum(rows, ["source"], ["doc_id", "text_hash"], "size", "start"), "mix-sizes")


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source: number, size, target, blocks and slots.

    Sources in code point order, null last, weigh WEIGHTS in turn and share
    SHARE of all words; a target stops at MOST times the source, and what is
    above is shared again by weight.  Ordered by size per weight, the sources
    that stop come first, which gives the final level at once.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everyone = Window.partitionBy()
    df = by_source.withColumn("source_no", (F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())) - 1).cast("int"))
    df = df.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in WEIGHTS]),
                                       F.col("source_no") % len(WEIGHTS)))
    df = df.withColumn("cap", MOST * F.col("source_size").cast("double"))
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    df = df.withColumns({
        "all": SHARE * F.sum("source_size").over(everyone),
        "capped_before": F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "weight_from": F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing)),
    })
    df = df.withColumn("stops", F.col("cap") / F.col("weight")
                       < (F.col("all") - F.col("capped_before")) / F.col("weight_from"))
    level = ((F.col("all") - F.coalesce(F.sum(F.when(F.col("stops"), F.col("cap"))).over(everyone), F.lit(0.0)))
             / F.sum(F.when(~F.col("stops"), F.col("weight"))).over(everyone))
    df = df.withColumn("target", F.when(F.col("stops"), F.col("cap")).otherwise(
        F.least("cap", F.col("weight") * level)))
    df = df.withColumn("blocks", F.ceil(F.col("source_size") / BLOCK_WORDS).cast("long"))
    slots = F.when(F.col("source_size") > 0, F.least(
        F.round(F.col("target") * F.col("blocks") / F.col("source_size")), MOST * F.col("blocks"))).otherwise(0)
    return cut(df.select("source", "source_no", "source_size", "target", "blocks", slots.cast("long").alias("slots")),
               "mix-targets")


def permute(index: np.ndarray, n: int, key: np.ndarray) -> np.ndarray:
    """Pseudorandom permutation of range(n), one for each key, at the given indexes."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    x = index.astype(np.uint64)
    out = np.full(len(x), n, dtype=np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x >> shift, x & mask
        with np.errstate(over="ignore"):
            for turn in range(4):
                f = (right + key + np.uint64(turn + 1) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
                f ^= f >> np.uint64(31)
                f *= np.uint64(0x94D049BB133111EB)
                left, right = right, left ^ ((f >> np.uint64(29)) & mask)
        x = (left << shift) | right
        done = x < np.uint64(n)
        out[todo[done]] = x[done]
        todo, x, key = todo[~done], x[~done], key[~done]
    return out.astype(np.int64)


def _keys(seed: int, source: int, epoch: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        k = np.uint64(seed) + np.uint64(source) * np.uint64(0xD1342543DE82EF95) + epoch.astype(np.uint64)
        k = (k ^ (k >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return k ^ (k >> np.uint64(33))


def drawn_slots(targets: DataFrame, seed: int = SEED) -> DataFrame:
    """Slots of the mix: shard, source_no, epoch, block and ``turn`` (a shard is read in order of turn)."""
    spark = targets.sparkSession
    shards = max(1, -(-int(targets.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]) // SHARD_BLOCKS))

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for s in f.itertuples():
                rng = np.random.default_rng([seed, s.source_no])
                n = rng.multinomial(s.slots, np.full(shards, 1 / shards))
                yield pd.DataFrame({"source_no": s.source_no, "blocks": s.blocks, "shard": np.arange(shards),
                                    "first": np.cumsum(n) - n, "n": n})

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in b.to_pylist():
                for a in range(s["first"], s["first"] + s["n"], 1 << 18):
                    slot = np.arange(a, min(a + (1 << 18), s["first"] + s["n"]))
                    epoch = slot // s["blocks"]
                    block = permute(slot % s["blocks"], s["blocks"], _keys(seed, s["source_no"], epoch))
                    turn = _keys(seed, s["source_no"] + s["shard"], slot).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(slot), v, dtype=t)) for v, t in
                         ((s["shard"], np.int64), (s["source_no"], np.int32))]
                        + [pa.array(epoch.astype(np.int32)), pa.array(block), pa.array(turn)],
                        ["shard", "source_no", "epoch", "block", "turn"])

    counts = targets.filter("slots > 0").select("source_no", "blocks", "slots").mapInPandas(
        draw, "source_no int, blocks long, shard long, first long, n long")
    counts = counts.filter("n > 0").repartition(partitions(spark), "source_no", "shard")
    return counts.mapInArrow(expand, "shard long, source_no int, epoch int, block long, turn long")


def plan(docs: DataFrame, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sizes with the source's number, size and target; the slots; and spans:
    the words ``low`` to ``high`` of the document at (source_no, start) that
    lie in a block."""
    sizes = document_sizes(docs)
    targets = source_targets(sizes)
    sizes = join_groups(sizes, targets.drop("blocks", "slots"), ["source"],
                        F.xxhash64("doc_id", "text_hash"))
    first = F.floor(F.col("start") / BLOCK_WORDS).cast("long")
    last = F.floor((F.col("start") + F.col("size") - 1) / BLOCK_WORDS).cast("long")
    spans = (sizes.filter("size > 0").select("source_no", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
             .select("source_no", "start", "block",
                     F.greatest(F.lit(0), F.col("block") * BLOCK_WORDS - F.col("start")).alias("low"),
                     F.least("size", (F.col("block") + 1) * BLOCK_WORDS - F.col("start")).alias("high")))
    return sizes, drawn_slots(targets, seed), spans


def taken_words(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of every row."""
    sizes, slots, spans = plan(docs, seed)
    uses = slots.groupBy("source_no", "block").agg(F.count("*").alias("uses"))
    # The slots' size is estimated from the small table they are made of; the hint
    # keeps them from being broadcast.
    taken = (spans.join(uses.hint("merge"), ["source_no", "block"])
             .groupBy("source_no", "start").agg(F.sum((F.col("high") - F.col("low")) * F.col("uses")).alias("taken"))
             .withColumnsRenamed({"source_no": "_no", "start": "_start"}))
    at = (F.col("source_no") == F.col("_no")) & (F.col("start") == F.col("_start")) & (F.col("size") > 0)
    return sizes.join(taken.hint("merge"), at, "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _pieces(text: bytes, spans: list[tuple[int, int, int]]) -> list[str]:
    """A text for each epoch: the taken words as they stand, a line break where words are left out."""
    at = [m.span() for m in _WORD.finditer(text)]
    out = []
    for epoch in sorted({e for e, _, _ in spans}):
        runs: list[list[int]] = []
        for _, low, high in sorted(s for s in spans if s[0] == epoch):
            if runs and runs[-1][1] == low:
                runs[-1][1] = high
            else:
                runs.append([low, high])
        if runs == [[0, len(at)]]:
            out.append(text.decode())
        else:
            out.append(b"\n".join(text[at[a][0]:at[b - 1][1]] for a, b in runs).decode())
    return out


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix as documents: a row for each document and epoch with the words
    taken, all other columns as they were (``n_chars`` counted again)."""
    sizes, slots, spans = plan(docs, seed)
    taken = (spans.join(slots.select("source_no", "block", "epoch").hint("merge"), ["source_no", "block"])
             .groupBy("source_no", "start")
             .agg(F.flatten(F.collect_list(F.array(F.col("epoch").cast("long"), "low", "high"))).alias("spans")))
    copy = Window.partitionBy("doc_id", "text_hash", "source").orderBy("start")
    taken = (sizes.join(taken, ["source_no", "start"]).filter("size > 0")
             .select("doc_id", "source", "text_hash", "start", "spans"))
    numbered = sizes.select("doc_id", "source", "text_hash", "start", F.row_number().over(copy).alias("_copy"))
    taken = (taken.join(numbered.withColumnsRenamed({c: f"_{c}" for c in ("doc_id", "source", "text_hash", "start")}),
                        F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source"))
                        & (F.col("text_hash") == F.col("_text_hash")) & (F.col("start") == F.col("_start")))
             .select("_doc_id", "_source", "_text_hash", "_copy", F.col("spans").alias("_spans")))
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", "source", "text", F.xxhash64("text").alias("text_hash"))
    rows = rows.withColumn("_no", F.row_number().over(
        Window.partitionBy("doc_id", "text_hash", "source").orderBy("text_hash")))
    rows = rows.join(taken, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source"))
                     & (F.col("text_hash") == F.col("_text_hash")) & (F.col("_no") == F.col("_copy")))

    def cut_texts(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_pieces(t.encode(), [tuple(map(int, s[k:k + 3])) for k in range(0, len(s), 3)])
                          for t, s in zip(texts, spans)])

    texts = F.pandas_udf(cut_texts, "array<string>")(F.col("text"), F.col("_spans"))
    rows = rows.select("_row", F.explode(texts).alias("_text"))
    new = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return rows.select(*[(new[c] if c in new else F.col("_row")[c]).alias(c) for c in docs.columns])
