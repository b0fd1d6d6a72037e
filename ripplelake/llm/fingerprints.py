"""Document fingerprints: invertible Bloom lookup sketches of paragraphs,
DataFrame operations only.

A text is the set of digests (xxhash64) of its paragraphs: non-empty lines, a
long line cut at the first sentence end after every ``LEAST`` code points, so that an
edit in a line leaves the paragraphs before it as they were.
Its sketch has ``TABLES`` sub-tables of cells; each digest is added to one cell
of each, and a cell holds the number of digests, their xor and the xor of
their check hashes.  Two versions are compared by subtracting cells: what both
hold cancels.  Cells left with one digest (count 1 or -1, check matches) give
it away; it is taken out of its other cells, sub-table by sub-table, until
nothing is left.  If something is left after ``SWEEPS``, the pair is tried again
with sketches twice as large.  The likeness of two versions is the Jaccard
index of their paragraph sets, from the set sizes and the recovered
differences.  The fingerprint of one text is its smallest sketch, as text.

Scale: subtraction and peeling are aggregations of cells by pair.  A pair's
cells come from one row, dealt by pair once, so the chain of
aggregations needs no further shuffle, and its work is linear in the
paragraphs, also of very long texts.  Texts are shuffled once and the heads that go
into edited texts once; the successor of each id is found on ids alone, by
ranges, without one window over all rows.

Defined cases: a null text is empty; an empty text has no paragraphs, and two such
texts are alike (1.0).  Rows that repeat an id and text are one document for
the order, and each gets the same result; equal ids with different texts follow in order
of the text's hash; rows without an id come first.  A single document is its
own successor.  An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, partitions, text_of

TABLES, SWEEPS = 3, 4
#: Cells of a fingerprint's sub-table; pairs start with the first power of two at which START_LOAD
#: of their paragraphs have a cell.
FINGERPRINT_CELLS, START_LOAD, MAX_LEVELS = 8, 0.75, 24
LEAST = 80
PARAGRAPH = rf"[^\n]{{{LEAST},}}?[.!?](?= |\n|$)|[^\n]+"
NO_ID = -(2**63) + 1


def paragraph_digests(text: Column) -> Column:
    """Distinct digests of the paragraphs of a non-null text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)),
                                        lambda x: F.xxhash64(x)))


def _cell(digest: Column, table: Column | int, cells: Column | int) -> Column:
    t = F.lit(table) if isinstance(table, int) else table
    return F.pmod(F.xxhash64(digest, t), F.lit(cells) if isinstance(cells, int) else cells).cast("long")


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(-1))


def fingerprint(digests: Column) -> Column:
    """Set size and the cells (count:digests:checks) of the smallest sketch, as text."""
    def xor(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))

    def cell(i: Column) -> Column:
        table = (i / FINGERPRINT_CELLS).cast("int")
        mine = F.filter(digests, lambda d: _cell(d, table, FINGERPRINT_CELLS) == i % FINGERPRINT_CELLS)
        return F.when(F.size(mine) == 0, F.lit("")).otherwise(F.concat_ws(
            ":", F.size(mine).cast("string"), F.lower(F.hex(xor(mine))),
            F.lower(F.hex(xor(F.transform(mine, _check))))))

    cells = F.transform(F.sequence(F.lit(0), F.lit(TABLES * FINGERPRINT_CELLS - 1)), cell)
    return F.concat(F.size(digests).cast("string"), F.lit("/"), F.array_join(cells, "."))


def _with_cells(pairs: DataFrame) -> DataFrame:
    """Add the cells of a sub-table that a pair starts with."""
    both = F.greatest(F.size("left") + F.size("right"), F.lit(1))
    return pairs.withColumn("cells", F.greatest(F.lit(FINGERPRINT_CELLS), F.pow(
        F.lit(2.0), F.ceil(F.log2(START_LOAD * both / TABLES))).cast("int")))


def _peel(pairs: DataFrame) -> DataFrame:
    """What is left of the subtracted sketches after peeling: pair, t, c, n; the
    recovered digests are the cells ``c`` of sub-table TABLES, with sign ``n``.
    ``pairs``: pair, cells, left, right."""
    deal = pairs.repartition(partitions(pairs.sparkSession), "pair")
    sides = F.concat(F.transform("left", lambda d: F.struct(d.alias("key"), F.lit(1).alias("n"))),
                     F.transform("right", lambda d: F.struct(d.alias("key"), F.lit(-1).alias("n"))))
    rows = deal.select("pair", "cells", F.explode(sides).alias("d")).select("pair", "cells", "d.key", "d.n")
    rows = rows.select("pair", "cells", "key", "n", F.explode(F.array(*[F.lit(t) for t in range(TABLES)])).alias("t"))
    rows = rows.select("pair", "cells", "t", _cell(F.col("key"), F.col("t"), F.col("cells")).alias("c"),
                       "n", "key", _check(F.col("key")).alias("chk"))

    def summed(df: DataFrame) -> DataFrame:
        return (df.groupBy("pair", "cells", "t", "c")
                .agg(F.sum("n").cast("int").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("chk").alias("chk"))
                .filter("n <> 0 or key <> 0 or chk <> 0"))

    def entry(t: int, c: Column, n: Column, key: Column, chk: Column) -> Column:
        return F.struct(F.lit(t).alias("t"), c.alias("c"), n.alias("n"), key.alias("key"), chk.alias("chk"))

    state = summed(rows)
    key, n, zero = F.col("key"), F.col("n"), F.lit(0).cast("long")
    for turn in range(TABLES * SWEEPS):
        mine = turn % TABLES
        single = (F.col("t") == mine) & (F.abs("n") == 1) & (F.col("chk") == _check(key))
        out = [entry(TABLES, key, n, zero, zero)] + [
            entry(t, _cell(key, t, F.col("cells")), -n, key, F.col("chk")) for t in range(TABLES) if t != mine]
        same = F.struct("t", "c", "n", "key", "chk")
        state = summed(state.select("pair", "cells", F.explode(
            F.when(single, F.array(*out)).otherwise(F.array(same))).alias("e")).select("pair", "cells", "e.*"))
    return state.select("pair", "t", "c", "n")


def _levels(pairs: DataFrame, name: str, peel) -> DataFrame:
    """Union of what ``peel`` makes of pairs, tried with twice the cells as long
    as its rows of a pair have ``failed``."""
    left, done = _with_cells(pairs), []
    for _ in range(MAX_LEVELS):
        peeled = cut(peel(left), name)
        failed = peeled.filter("failed").select("pair").distinct()
        done.append(peeled.join(failed, "pair", "left_anti").drop("failed"))
        if failed.isEmpty():
            return reduce(DataFrame.union, done)
        left = left.join(failed, "pair", "left_semi").withColumn("cells", F.col("cells") * 2)
    raise RuntimeError(f"pairs still don't peel with 2**{MAX_LEVELS} times the cells they began with")


def differences(pairs: DataFrame) -> DataFrame:
    """(pair, digest, sign) of the paragraphs that differ: sign 1 for those of
    ``left`` only, -1 for those of ``right``.

    ``pairs`` holds ``pair`` (unique), ``left`` and ``right`` (digest arrays).
    Equal pairs have no row.
    """
    return _levels(pairs, "peeled", lambda x: _peel(x).select(
        "pair", F.col("c").alias("digest"), F.col("n").alias("sign"), (F.col("t") < TABLES).alias("failed")))


def difference_counts(pairs: DataFrame) -> DataFrame:
    """(pair, differing): how many digests ``differences`` recovers."""
    return _levels(pairs, "peeled-counts", lambda x: _peel(x).groupBy("pair").agg(
        F.count_if(F.col("t") == TABLES).alias("differing"), F.bool_or(F.col("t") < TABLES).alias("failed")))


def successors(docs: DataFrame) -> DataFrame:
    """Each document's key (k, h) with the key and half length of the document before it, in a circle."""
    spark = docs.sparkSession
    ids = docs.select("k", "h", F.floor(F.length("text") / 2).cast("int").alias("half")).distinct()
    ids = cut(ids.repartitionByRange(partitions(spark), "k", "h").withColumn("range", F.spark_partition_id()), "ids")
    inside = Window.partitionBy("range").orderBy("k", "h")
    before = ids.withColumn("prev", F.lag(F.struct("k", "h", "half")).over(inside))
    # One row per range: the last document of the ranges before it.
    lasts = ids.groupBy("range").agg(F.max(F.struct("k", "h", "half")).alias("last"))
    in_order = Window.orderBy("range")
    lasts = lasts.select(F.col("range").alias("_range"), F.coalesce(
        F.lag("last").over(in_order),
        F.last("last").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_last"))
    prev = F.coalesce("prev", "_last")
    return cut(before.join(lasts, F.col("range") == F.col("_range")).select(
        "k", "h", prev["k"].alias("prev_k"), prev["h"].alias("prev_h"), prev["half"].alias("prev_half")), "successors")


def versions(docs: DataFrame) -> DataFrame:
    """Every row with its edited text's hash and the digests of its own, its
    edited and its successor's paragraphs.

    Edited: the last floor(n/2) code points are replaced by the first as many
    of the successor.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("k"),
                       F.xxhash64(text_of()).alias("h"), text_of().alias("text"))
    placed = rows.join(successors(rows).hint("merge"), ["k", "h"])
    # One of the rows that repeat an id and text hands its head on.
    copy = F.row_number().over(Window.partitionBy("k", "h").orderBy("h"))
    heads = placed.withColumn("copy", copy).filter("copy = 1").select(
        F.col("prev_k").alias("k"), F.col("prev_h").alias("h"), F.left("text", F.col("prev_half")).alias("head"),
        paragraph_digests(F.col("text")).alias("next_digests"))
    n = F.length("text")
    joined = placed.select("k", "h", "text").join(heads.hint("merge"), ["k", "h"])
    joined = joined.withColumn("edited", F.concat(F.left("text", n - F.floor(n / 2).cast("int")), "head"))
    return cut(joined.select(
        F.when(F.col("k") != NO_ID, F.col("k")).alias("doc_id"), n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), paragraph_digests(F.col("text")).alias("digests"),
        paragraph_digests(F.col("edited")).alias("edited_digests"), "next_digests",
        F.monotonically_increasing_id().alias("row")), "versions")


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row's text and edited text, and their likeness to the edited text and the successor."""
    rows = versions(docs)
    pairs = rows.select(F.explode(F.array(
        F.struct((2 * F.col("row")).alias("pair"), F.col("digests").alias("left"), F.col("edited_digests").alias("right")),
        F.struct((2 * F.col("row") + 1).alias("pair"), F.col("digests").alias("left"), F.col("next_digests").alias("right"))
    )).alias("p")).select("p.*")
    even = F.col("pair") % 2 == 0
    counts = (difference_counts(pairs).groupBy(F.shiftright("pair", 1).alias("_row"))
              .agg(F.sum(F.when(even, F.col("differing"))).alias("d_edited"),
                   F.sum(F.when(~even, F.col("differing"))).alias("d_next")))

    def likeness(right: str, differing: str) -> Column:
        both, d = F.size("digests") + F.size(right), F.coalesce(differing, F.lit(0))
        return F.when(both == 0, 1.0).otherwise((both - d) / (both + d))

    out = rows.join(counts, F.col("row") == F.col("_row"), "left")
    return out.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("digests")).alias("fingerprint"),
                      fingerprint(F.col("edited_digests")).alias("edited_fingerprint"),
                      likeness("edited_digests", "d_edited").alias("near_edited"),
                      likeness("next_digests", "d_next").alias("near_next"))
