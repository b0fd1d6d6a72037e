"""Ranked lexical search with buckets by vector length (as LEMP).

A document is a vector of impacts, one coordinate per term of the queries,
each scaled by the root of the term's weight, so that the inner product with a
query's vector is its score.  Every task orders its vectors by length and cuts
them into buckets.  With t the score of a query's tenth best document so far:

* Cauchy-Schwarz: a bucket whose longest vector times the query's length is
  below t holds nothing for that query, nor does any later one;
* coordinates: of the query's terms in a bucket, the heaviest form the focus,
  just so many that the others' length times the bucket's is below t.  Only
  documents with a focus term can qualify; their part of the score and of the
  length on the focus is summed from the bucket's postings, and the rest is
  bounded by the two remaining lengths;
* survivors are scored exactly in 64-bit integers.

Bounds are floats with a margin above their rounding; only a bound strictly
below t prunes, so ties stay.  A last window ranks the tasks' best.

Scale: texts are read once per block of queries into a table of the matching
terms; statistics are summed by task.  No documents are shuffled: tasks search
what they have read and pass on ten rows per query.  Queries are a stated
set, taken in blocks of ``BLOCK`` items or ``BLOCK_TERMS`` terms, so what goes to every
task is bounded.  A task holds one partition's vectors in Spark's sort and one
bucket of ``BUCKET`` documents in Python.

Defined cases: null or empty texts, and texts without a term, are no documents
and no queries; every row of either table counts by itself, so repeated rows
are ranked beside each other; rows without doc_id come last among equal
scores; an empty table on either side gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import TEXTS, cut, ship

ship(__name__)

TOP = 10
BLOCK, BLOCK_TERMS = 2000, 500_000
BUCKET = 4096
K1_PERMILLE, B_PERCENT = 8, 75
#: Bounds are raised by this share, far above the rounding of doubles.
MARGIN = 1 + 1e-9
#: Bytes that end a term: ASCII other than letters and digits.
_OUTSIDE = bytes(c for c in range(128) if not chr(c).isalnum())
_SPLIT = bytes.maketrans(_OUTSIDE, b" " * len(_OUTSIDE))


def terms_of(text: str | bytes | None) -> list[bytes]:
    raw = text.encode() if isinstance(text, str) else text or b""
    return raw.lower().translate(_SPLIT).split()


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tf) of every row with a term; ``terms`` are those of the vocabulary, as numbers."""
    kind = dict(docs.dtypes)["doc_id"]
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = known.value, len(known.value)
        for b in batches:
            found, n = [], []
            for i, t in enumerate(b.column("text").cast(pa.binary()).to_pylist()):
                terms = terms_of(t)
                n.append(len(terms))
                held = [number[x] for x in terms if x in number]
                found.append(np.array(held, dtype=np.int64) + i * size)
            key, tf = np.unique(np.concatenate(found) if found else np.empty(0, np.int64), return_counts=True)
            owner = key // max(1, size)
            ends = np.searchsorted(owner, np.arange(b.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (key % max(1, size), tf)]
            out = pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tf"])
            yield out.filter(pc.greater(out.column("n"), 0))

    rows = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, tf array<int>")
    return cut(rows, "term-vectors", TEXTS)


def statistics(rows: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents, their terms with repeats, and the documents that hold each term."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for b in batches:
            total += np.bincount(b.column("terms").flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "df"])

    total = rows.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(size, dtype=np.int64)
    found = rows.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df[found["term"].to_numpy()] = found["df"].to_numpy()  # a row per term of the block
    return total[0], total[1] or 0, df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)


class Queries:
    """The block's items: terms by falling coordinate, and the best scores of each."""

    def __init__(self, items: list[list[int]], weight: np.ndarray) -> None:
        self.terms, self.points, self.coords = [], [], []
        for terms in items:
            t, count = np.unique(np.array(terms, dtype=np.int64), return_counts=True)
            coord = count * np.sqrt(weight[t])
            order = np.argsort(-coord, kind="stable")
            self.terms.append(t[order])
            self.points.append((count * weight[t])[order])  # a coordinate's share of the score per impact
            self.coords.append(coord[order])
        self.best: list[list[tuple]] = [[] for _ in items]  # (-score, no id, doc_id)
        self.threshold = np.zeros(len(items), dtype=np.int64)

    def offer(self, q: int, scores: list[int], ids: list) -> None:
        best = self.best[q] + [(-s, i is None, i) for s, i in zip(scores, ids)]
        best.sort(key=lambda x: (x[0], x[1], 0 if x[1] else x[2]))
        self.best[q] = best[:TOP]
        if len(best) >= TOP:
            self.threshold[q] = -self.best[q][-1][0]


class Bucket:
    """Documents of similar length with postings by term."""

    def __init__(self, b: pa.RecordBatch, weight: np.ndarray) -> None:
        self.norm = b.column("norm").to_numpy()
        self.terms = b.column("terms").flatten().to_numpy().astype(np.int64)
        self.impacts = b.column("impacts").flatten().to_numpy().astype(np.int64)
        self.ends = b.column("terms").offsets.to_numpy().astype(np.int64) - b.column("terms").offsets[0].as_py()
        self.ids = b.column("doc_id")
        order = np.argsort(self.terms, kind="stable")
        self.docs = np.repeat(np.arange(b.num_rows), np.diff(self.ends))[order]
        self.values = self.impacts[order]
        self.squares = weight[self.terms[order]] * self.values.astype(np.float64) ** 2
        self.starts = np.searchsorted(self.terms[order], np.arange(len(weight) + 1))
        place = pc.sort_indices(self.ids, null_placement="at_end").to_numpy()
        self.place = np.empty(len(place), dtype=np.int64)
        self.place[place] = np.arange(len(place))

    def search(self, queries: Queries, q: int, points: np.ndarray) -> bool:
        """Offer the query its documents; False if no later bucket can hold one.  ``points``: zeros, left so."""
        t, least = queries.terms[q], max(1, int(queries.threshold[q]))
        if math.sqrt((queries.coords[q] ** 2).sum()) * self.norm[0] * MARGIN < least:
            return False
        here = self.starts[t + 1] > self.starts[t]
        t, gain, coord = t[here], queries.points[q][here], queries.coords[q][here]
        # rest[j]: length of the query without its first j terms
        rest = np.sqrt(np.append(np.cumsum((coord ** 2)[::-1])[::-1], 0.0))
        focus = int(np.argmax(rest * self.norm[0] * MARGIN < least))
        if not focus:
            return True
        size = self.starts[t[:focus] + 1] - self.starts[t[:focus]]
        at = np.arange(size.sum()) + np.repeat(self.starts[t[:focus]] - (np.cumsum(size) - size), size)
        docs = self.docs[at]
        score = np.bincount(docs, weights=np.repeat(gain[:focus], size) * self.values[at], minlength=len(self.norm))
        square = np.bincount(docs, weights=self.squares[at], minlength=len(self.norm))
        left = np.sqrt(np.maximum(self.norm ** 2 * MARGIN - square, 0))
        found = np.flatnonzero((square > 0) & ((score + rest[focus] * left) * MARGIN >= least))
        if len(found):
            points[t] = gain
            size = self.ends[found + 1] - self.ends[found]
            at = np.arange(size.sum()) + np.repeat(self.ends[found] - (np.cumsum(size) - size), size)
            exact = np.add.reduceat(points[self.terms[at]] * self.impacts[at], np.cumsum(size) - size)
            points[t] = 0
            held = exact >= least
            found, exact = found[held], exact[held]
            first = np.lexsort((self.place[found], -exact))[:TOP]
            queries.offer(q, exact[first].tolist(), self.ids.take(pa.array(found[first])).to_pylist())
        return True


def _ranked(docs: DataFrame, items: list[list[bytes]]) -> DataFrame:
    """(item, doc_id, score): the best documents of each item of a block, by its number."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)["doc_id"]
    vocabulary: dict[bytes, int] = {}
    numbers = [[vocabulary.setdefault(t, len(vocabulary)) for t in terms] for terms in items]
    rows = vectors(docs, vocabulary)
    n_docs, n_terms, df = statistics(rows, len(vocabulary))
    shared = spark.sparkContext.broadcast((numbers, weights(n_docs, df)))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value[1]
        for b in batches:
            terms, n = b.column("terms"), b.column("n").to_numpy()
            size = np.diff(terms.offsets.to_numpy())
            flat, tf = terms.flatten().to_numpy(), b.column("tf").flatten().to_numpy().astype(np.int64)
            m = 100 - B_PERCENT + (B_PERCENT * n * n_docs) // n_terms
            impact = (1_000_000_000 * tf) // (1000 * tf + K1_PERMILLE * np.repeat(m, size))
            owner = np.repeat(np.arange(b.num_rows), size)
            norm = np.sqrt(np.bincount(owner, weights=weight[flat] * impact.astype(np.float64) ** 2, minlength=b.num_rows))
            offsets = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(norm), pa.ListArray.from_arrays(offsets, pa.array(flat)),
                 pa.ListArray.from_arrays(offsets, pa.array(impact.astype(np.int32)))], ["doc_id", "norm", "terms", "impacts"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = shared.value
        queries, points = Queries(asked, weight), np.zeros(len(weight), dtype=np.int64)
        open_ = [q for q, t in enumerate(asked) if t]
        for batch in batches:
            for k in range(0, batch.num_rows if open_ else 0, BUCKET):
                bucket = Bucket(batch.slice(k, BUCKET), weight)
                open_ = [q for q in open_ if bucket.search(queries, q, points)]
        found = [(q, -s, i) for q, best in enumerate(queries.best) for s, _, i in best]
        item, score, ids = zip(*found) if found else ((), (), ())
        schema = pa.schema([("item", pa.int64()), ("doc_id", batch_type[0]), ("score", pa.int64())])
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(ids, batch_type[0]), pa.array(score, pa.int64())],
                                         schema=schema)

    batch_type = [rows.select("doc_id").limit(0).toArrow().schema.field(0).type]
    vectors_ = rows.filter(F.size("terms") > 0).mapInArrow(weigh, f"doc_id {kind}, norm double, terms array<int>, impacts array<int>")
    found = vectors_.sortWithinPartitions(F.desc("norm")).mapInArrow(search, f"item long, doc_id {kind}, score long")
    return cut(found, "found")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item; at most TOP of them."""
    spark, parts, block, n_terms = docs.sparkSession, [], [], 0
    kind = dict(items.dtypes)["item_id"]

    def flush() -> None:
        names = spark.createDataFrame([(k, item_id) for k, (item_id, _) in enumerate(block)], f"item long, item_id {kind}")
        parts.append(_ranked(docs, [t for _, t in block]).join(names, "item"))

    for r in items.select("item_id", "text").toLocalIterator():
        block.append((r.item_id, terms_of(r.text)))
        n_terms += len(block[-1][1])
        if len(block) >= BLOCK or n_terms >= BLOCK_TERMS:
            flush()
            block, n_terms = [], 0
    if block or not parts:
        flush()
    order = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = None
    for k, p in enumerate(parts):
        p = p.withColumn("block", F.lit(k))
        found = p if found is None else found.unionByName(p)
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= min(top, TOP))
    return found.select("item_id", "rank", "doc_id", "score")
