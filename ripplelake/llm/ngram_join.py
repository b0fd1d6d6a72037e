"""N-gram Jaccard join: exact near-duplicate components in Jaccard metric space.

Documents are sets of 5-word shingles under the distance 1 - J, a metric.  Two
documents link within ``RADIUS`` = 0.25.

* **First-level pivots** are one-shingle sets.  Unrelated texts are at distance
  exactly 1 from each other, so document pivots alone can't divide a corpus;
  the distance to {x} is below 1 only for documents that hold x.  Under one
  order of all shingles, rarest first, linked documents share an x among the
  first ``n - ceil(0.75 n) + 1`` of each: a document is replicated to those
  regions and no other.  The first shared x also bounds the overlap by what
  remains behind it, which limits the sizes of the partners that a region
  must try (``most``).
* **Document pivots** divide regions.  In each region the members of least
  hash are pivots, and their distances to the members are measured, a number
  linear in the region.  Members take a measured pivot as home (Voronoi cells);
  members linked to a pivot are one component at once and need no further
  comparison with each other.
* **Triangle-inequality windows** leave, of the pairs across components, those
  whose distances from a shared pivot differ by at most RADIUS; these go
  through the next round with other and more pivots, and the last round
  measures all that are left.  A round without open pairs ends the join only if
  no region has more members than its pivots.  Regions above ``BLOCK`` members are dealt in pairs of blocks.

Every pair within RADIUS is measured or already connected, so components are
exact.  Shingles are 64-bit hashes, sets of equal shingles are found by a
128-bit digest and go on as one class.  The order comes from a count sketch of
fixed size over all documents (4 MB broadcast); it decides speed, not results.
Nothing is capped or sampled.

Scale: texts are read twice; what is shuffled are prefixes (a quarter of the
shingles), then only classes in regions of two or more; sets travel only for
measured pairs.

Defined cases: null, empty or blank text has no shingles and links with nothing
(its component is its own id); texts under five words are one shingle; equal
texts are linked; repeated rows give repeated results; rows without an id join
classes by text, and a component of only such rows has a null id.  An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import TEXTS, WordHashes, cut, join_groups, partitions, ship
from .components import connected_components

ship(__name__)

WORDS = 5
#: Link: 100 * intersection >= 75 * union, so distance at most RADIUS.
PERCENT, RADIUS = 75, 0.25
CELLS, CHUNK = 1 << 22, 1 << 16
BLOCK = 4096
#: Document pivots of a region in each round; in the last, all its members.
PIVOTS = (8, 64, None)
#: Hashes of rows looked for are broadcast below this many (8 bytes a row).
BROADCAST_NODES = 1_000_000
WORD_CACHE = 400_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Sets of shingle hashes of texts; remembers the hashes of words."""

    def __init__(self) -> None:
        self.known = WordHashes()

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        known = self.known
        if len(known) > WORD_CACHE:
            known.clear()
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        k = min(WORDS, len(h))
        with np.errstate(over="ignore"):
            g = h[:len(h) - k + 1] + np.uint64(k)
            for j in range(1, k):
                g = g * _MIX + h[j:len(h) - k + 1 + j]
            g ^= g >> np.uint64(29)
            g *= np.uint64(0xBF58476D1CE4E5B9)
            g ^= g >> np.uint64(32)
        return np.unique(g)


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def shingle_sketch(docs: DataFrame) -> bytes:
    """How often shingles of each cell occur in all documents, on a log scale, a byte a cell."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, shingles = np.zeros(CELLS, dtype=np.uint32), Shingler()
        for b in batches:
            sets = [shingles(t) for t in b.column("text").cast(pa.binary()).to_pylist()]
            if sets:
                total += np.bincount(_cells(np.concatenate(sets)), minlength=CELLS).astype(np.uint32)
        parts = [(k, total[k * CHUNK:(k + 1) * CHUNK]) for k in range(CELLS // CHUNK)]
        parts = [(k, x) for k, x in parts if x.any()]
        # A task's count above 255 is clipped: the order is a heuristic.
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int32()),
                                          pa.array([np.minimum(x, 255).astype(np.uint8).tobytes() for _, x in parts],
                                                   pa.binary())], ["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, x in zip(b.column("chunk").to_pylist(), b.column("counts").to_pylist()):
                total[k] = total.get(k, np.zeros(CHUNK, dtype=np.uint64)) + np.frombuffer(x, dtype=np.uint8)
        scaled = [np.minimum(255, 6 * np.log2(1.0 + x)).astype(np.uint8).tobytes() for x in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(scaled, pa.binary())],
                                         ["chunk", "counts"])

    counts = docs.select("text").mapInArrow(count, "chunk int, counts binary")
    counts = cut(counts.repartition(16, "chunk").mapInArrow(add, "chunk int, counts binary"), "shingle-sketch", TEXTS)
    sketch = np.zeros(CELLS, dtype=np.uint8)
    for r in counts.collect():  # CELLS bytes in all
        sketch[r.chunk * CHUNK:(r.chunk + 1) * CHUNK] = np.frombuffer(r.counts, dtype=np.uint8)
    return sketch.tobytes()


def shingle_rows(docs: DataFrame) -> DataFrame:
    """Every row's doc_id, text hash, set size, set digest and the first-level pivots (``prefix``) in order."""
    sketch = docs.sparkSession.sparkContext.broadcast(shingle_sketch(docs))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, shingles = np.frombuffer(sketch.value, dtype=np.uint8), Shingler()
        for b in batches:
            n, digest, prefix = [], [], []
            for t in b.column("text").cast(pa.binary()).to_pylist():
                s = shingles(t)
                n.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                first = np.lexsort((s, often[_cells(s)]))[:len(s) - -(-PERCENT * len(s) // 100) + 1]
                prefix.append(s[first].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(prefix, pa.binary())], ["doc_id", "text_hash", "n_shingles", "digest", "prefix"])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return cut(rows.mapInArrow(run, f"doc_id {kind}, text_hash long, n_shingles long, digest binary, prefix binary"),
               "shingle-rows", TEXTS)


def _members(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (pivot, node, n, most) of first-level regions, and the pairs
    (a, b) of regions of two, which need no pivot.

    A pair in a region must be tried if each one's size is at most the other's ``most``.
    """
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                prefix = [np.frombuffer(x, dtype=np.int64) for x in part.column("prefix").to_pylist()]
                size = np.array(part.column("n_shingles").to_pylist(), dtype=np.int64)
                held = np.array([len(x) for x in prefix], dtype=np.int64)
                at = np.concatenate([np.arange(x) for x in held] or [np.empty(0, np.int64)])
                n = np.repeat(size, held)
                # overlap needed: (p / (100 + p)) * (n_a + n_b); at most n - at is left
                most = (100 + PERCENT) * (n - at) // PERCENT - n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(prefix) if prefix else np.empty(0, np.int64)),
                     pa.array(np.repeat(np.array(part.column("node").to_pylist(), dtype=np.int64), held)),
                     pa.array(n.astype(np.int32)), pa.array(most.astype(np.int32))], ["pivot", "node", "n", "most"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by pivot; drops those that are alone.  A region of
        two inside a batch becomes a row with its second member as ``other``."""
        last, waiting = None, None
        for b in batches:
            if waiting is not None:
                b = pa.Table.from_batches([waiting, b]).combine_chunks().to_batches()[0]
            p, node, n, most = (b.column(c).to_numpy() for c in ("pivot", "node", "n", "most"))
            if not len(p):
                continue
            same = p[1:] == p[:-1]
            from_before = last is not None and waiting is None and p[0] == last
            keep = np.append(same, False) | np.concatenate([[from_before], same])
            start = np.concatenate([[0], np.flatnonzero(~same) + 1])
            size = np.diff(np.append(start, len(p)))
            two = size == 2
            two[-1] = False
            two[0] &= not from_before
            x = start[two]
            keep[x] = keep[x + 1] = False
            x = x[(n[x] <= most[x + 1]) & (n[x + 1] <= most[x])]
            if len(x):
                both = np.unique(np.stack([np.minimum(node[x], node[x + 1]), np.maximum(node[x], node[x + 1])], 1), axis=0)
                none = np.zeros(len(both), dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(len(both), np.int64)), pa.array(both[:, 0]), pa.array(none), pa.array(none),
                     pa.array(both[:, 1])], ["pivot", "node", "n", "most", "other"])
            last, waiting = p[-1], None if keep[-1] else b.slice(len(p) - 1, 1)
            kept = b.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(np.full(kept.num_rows, -1, np.int64))],
                                             ["pivot", "node", "n", "most", "other"])

    kinds = "pivot long, node long, n int, most int"
    rows = classes.filter("n_shingles > 0").select("node", "n_shingles", "prefix").mapInArrow(post, kinds)
    rows = rows.repartition(partitions(classes.sparkSession), "pivot").sortWithinPartitions("pivot")
    found = cut(rows.mapInArrow(shared, kinds + ", other long"), "region-members")
    twos = found.filter("other >= 0").select(F.col("node").alias("a"), F.col("other").alias("b"))
    return found.filter("other < 0").drop("other"), twos


def _dealt(members: DataFrame) -> DataFrame:
    """Add the blocks (``i`` <= ``j``) that a member is compared in; a region of
    up to BLOCK members is one block."""
    large = cut(members.groupBy("pivot").count().filter(F.col("count") > BLOCK)
                .select("pivot", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "large-regions")
    if large.isEmpty():
        return members.withColumns({"i": F.lit(0), "j": F.lit(0), "own": F.lit(0)})
    df = members.join(large, "pivot", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    df = df.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    df = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return df.select("pivot", "node", "n", "most", F.least("own", "other").alias("i"),
                     F.greatest("own", "other").alias("j"), "own")


def _open_pairs(dealt: DataFrame, state: DataFrame | None, pivots: int | None, seed: int) -> DataFrame:
    """Pairs of each region that are still to be measured: of the region's
    ``pivots`` only, or all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def region(t: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            node, n, most, own = t["node"], t["n"], t["most"], t["own"]
            part, home, away = t["component"], t["home"], t["away"]
            rank = (node.astype(np.uint64) + np.uint64(seed)) * _MIX  # wraps
            few = pivots is not None and len(node) > pivots
            rows = np.argpartition(rank ^ (rank >> np.uint64(31)), pivots)[:pivots] if few else range(len(node) - 1)
            a, b = [], []
            one_block = t["i"][0] == t["j"][0]
            for x in rows:
                to = slice(0, None) if few else slice(x + 1, None)
                ok = (n[to] <= most[x]) & (n[x] <= most[to]) & (part[to] != part[x]) & (node[to] != node[x])
                if not one_block:
                    ok &= own[to] != own[x]
                # measured against the shared home pivot: window of the triangle inequality
                ok &= ~((home[to] == home[x]) & (np.abs(away[to] - away[x]) > RADIUS + 1e-9))
                ok &= (home[to] != node[x]) & (node[to] != home[x])
                found = node[to][ok]
                b.append(found)
                a.append(np.full(len(found), node[x]))
            return np.concatenate(a), np.concatenate(b)

        columns = ["pivot", "i", "j", "node", "n", "most", "own", "component", "home", "away"]
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            t = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in columns}
            if held is not None:
                t = {c: np.concatenate([held[c], t[c]]) for c in columns}
            if not len(t["node"]):
                continue
            new = (t["pivot"][1:] != t["pivot"][:-1]) | (t["i"][1:] != t["i"][:-1]) | (t["j"][1:] != t["j"][:-1])
            cuts = np.concatenate([[0], np.flatnonzero(new) + 1])
            yield from pairs(t, cuts, region)
            held = {c: v[cuts[-1]:] for c, v in t.items()}
        if held is not None and len(held["node"]):
            yield from pairs(held, np.array([0, len(held["node"])]), region)

    def pairs(t, cuts, region):
        # regions of one component are done
        part, starts = t["component"][:cuts[-1]], cuts[:-1]
        if not len(starts):
            return
        mixed = np.minimum.reduceat(part, starts) != np.maximum.reduceat(part, starts)
        found = [region({c: v[a:b] for c, v in t.items()}) for a, b in zip(cuts[:-1][mixed], cuts[1:][mixed])]
        if found:
            a, b = (np.concatenate(x) for x in zip(*found))
            both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    if state is None:
        df = dealt.withColumns({"component": F.col("node"), "home": -F.col("node") - 1, "away": F.lit(0.0)})
    else:
        df = dealt.join(state, "node", "left").withColumns({
            "component": F.coalesce("component", "node"), "home": F.coalesce("home", -F.col("node") - 1),
            "away": F.coalesce("away", F.lit(0.0))})
    df = df.select("pivot", "i", "j", "node", "n", "most", "own", "component", "home", "away")
    df = df.repartition(partitions(dealt.sparkSession), "pivot", "i", "j").sortWithinPartitions("pivot", "i", "j")
    return df.mapInArrow(run, "a long, b long").distinct()


def _among(rows: DataFrame) -> Callable[[str, str], Column]:
    """A test of (doc_id, text_hash) against those of ``rows``: none of them fails it, and hardly another row
    passes it.  Sorted 64-bit hashes are broadcast, 8 bytes a row where Spark's own broadcast takes over a hundred
    on the driver; what passes is matched exactly by a shuffle.
    """
    keys = np.sort(rows.select(F.xxhash64("doc_id", "text_hash").alias("key")).toArrow()["key"].to_numpy())
    shared = rows.sparkSession.sparkContext.broadcast(keys)

    @F.arrow_udf("boolean")
    def held(key: pa.Array) -> pa.Array:
        if not len(shared.value):
            return pa.array(np.zeros(len(key), dtype=bool))
        key = key.to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(shared.value, key), len(shared.value) - 1)
        return pa.array(shared.value[at] == key)

    return lambda doc_id, text_hash: held(F.xxhash64(doc_id, text_hash))


def _sets(docs: DataFrame, nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, shingles) of classes, from the text of one row of each."""
    wanted = nodes.join(classes, "node").select(F.col("label").alias("doc_id"), "text_hash", "node")
    wanted = cut(wanted, "wanted-classes")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.lit(None).cast("long").alias("node"), "text")
    if wanted.count() <= BROADCAST_NODES:
        rows = rows.filter(_among(wanted)("doc_id", "text_hash"))
    # Nodes meet their texts as rows of one group, which also holds ids that are null.
    rows = (rows.union(wanted.withColumn("text", F.lit(None).cast("string")))
            .groupBy("doc_id", "text_hash").agg(F.max("node").alias("node"), F.max("text").alias("text"))
            .filter("node is not null and text is not null"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler()
        for b in batches:
            sets = [shingles(t).tobytes() for t in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(sets, pa.large_binary()).cast(pa.binary())],
                                             ["node", "shingles"])

    return cut(rows.select("node", "text").mapInArrow(run, "node long, shingles binary"), "class-sets", TEXTS)


def _measure(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, distance, linked) of every pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away, linked = [], []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                union = len(x) + len(y) - common
                away.append(1 - common / union)
                linked.append(100 * common >= PERCENT * union)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(away, pa.float64()),
                                              pa.array(linked, pa.bool_())], ["a", "b", "away", "linked"])

    rows = (pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a"))
    return cut(rows.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, away double, linked boolean"),
               "distances", 100)


def _homes(measured: DataFrame) -> DataFrame:
    """Home pivot and distance from it of every measured node.

    Pivots are the members of least hash, so the measured neighbour of least hash is the home.
    """
    both = measured.select(F.col("a").alias("node"), F.col("b").alias("home"), "away").union(
        measured.select(F.col("b").alias("node"), F.col("a").alias("home"), "away"))
    return (both.groupBy("node").agg(F.min(F.struct(F.xxhash64("home"), "home", "away")).alias("best"))
            .select("node", "best.home", "best.away"))


def _state(measured: DataFrame, whole: bool) -> DataFrame:
    """Component, home pivot and distance from it of every measured node; ``whole``: each its own component."""
    homes = _homes(measured)
    if whole:
        return cut(homes.withColumn("component", F.col("node")), "join-state")
    return cut(homes.join(_parts(measured), "node", "left").withColumn("component", F.coalesce("component", "node")),
               "join-state")


def _largest(dealt: DataFrame) -> int:
    """Members of the largest region that is compared as one."""
    return dealt.groupBy("pivot", "i", "j").count().agg(F.max("count")).first()[0] or 0


def _parts(measured: DataFrame) -> DataFrame:
    return connected_components(measured.filter("linked"))


def _classes(rows: DataFrame) -> DataFrame:
    """One row for each set of shingles, with a node number and one of its rows (``label``, ``text_hash``)."""
    first = F.min(F.struct("doc_id", "text_hash"))
    return cut(rows.groupBy("digest").agg(F.min("doc_id").alias("label"), F.first("n_shingles").alias("n_shingles"),
                                          first.alias("one"), F.min_by("text_hash", "doc_id").alias("hash_of_label"),
                                          F.first("prefix").alias("prefix"))
               .select("digest", "label", "n_shingles", "prefix",
                       F.coalesce("hash_of_label", "one.text_hash").alias("text_hash"))
               .withColumn("node", F.monotonically_increasing_id()), "shingle-classes")


def _rounds(docs: DataFrame, classes: DataFrame, whole: bool) -> tuple[DataFrame | None, DataFrame | None, bool]:
    """Measured pairs, the state before the last round, and if the last round
    found links.  ``whole``: pairs inside a component are measured too."""
    members, twos = _members(classes)
    dealt = _dealt(members)
    measured: DataFrame | None = None
    state: DataFrame | None = None
    late, largest = False, None
    for turn, pivots in enumerate(PIVOTS):
        pairs = _open_pairs(dealt, state, pivots, turn)
        if measured is None:
            pairs = pairs.union(twos).distinct()
        else:
            pairs = pairs.join(measured.select("a", "b"), ["a", "b"], "left_anti")
        pairs = cut(pairs, "open-pairs")
        if pairs.isEmpty():
            # Pivots' pairs only: those of other members may still be open.
            largest = _largest(dealt) if largest is None else largest
            if pivots is None or largest <= pivots:
                break
            continue
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        found = _measure(pairs, _sets(docs, nodes, classes))
        measured = found if measured is None else measured.union(found)
        if pivots is not None:
            state = _state(measured, whole)
        else:
            late = not found.filter("linked").isEmpty()
    return measured, state, late


def _placed(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, component (a node) and its component_id (smallest doc_id) of every row."""
    rows = shingle_rows(docs)
    classes = _classes(rows)
    measured, state, late = _rounds(docs, classes, False)
    # No round, or a last round without links, leaves the components as they are.
    if measured is None:
        parts = classes.select("node", F.col("node").alias("component")).limit(0)
    elif state is not None and not late:
        parts = state.select("node", "component")
    else:
        parts = _parts(measured)
    named = (classes.select("node", "digest", "label", "n_shingles").join(parts, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    least = named.groupBy("component").agg(F.min("label").alias("component_id"))
    named = cut(named.join(least, "component").select("digest", "component", "component_id"), "components")
    return rows.select("doc_id", "text_hash", "n_shingles", "digest").join(named, "digest").drop("digest")


def components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable) of every row."""
    return _placed(docs).select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id"))
                                .otherwise(F.col("doc_id")).alias("component_id"))


def _links(classes: DataFrame, docs: DataFrame) -> DataFrame:
    measured, _, _ = _rounds(docs, classes, True)
    if measured is None:
        return classes.select(F.col("node").alias("a"), F.col("node").alias("b"), F.lit(0.0).alias("away")).limit(0)
    return measured.filter("linked").select("a", "b", "away")


def links(docs: DataFrame) -> DataFrame:
    """Every two classes (texts of equal shingles) within RADIUS, once: a_id,
    a_hash, b_id, b_hash (smallest doc_id and text hash of one text of each) and distance.

    Also the pairs inside a component are measured, so the work and the result
    grow with the square of a group of near copies; ``components`` needs neither.
    """
    classes = _classes(shingle_rows(docs))
    out = _links(classes, docs)
    for side in ("a", "b"):
        out = out.join(classes.select(F.col("node").alias(side), F.col("label").alias(f"{side}_id"),
                                      F.col("text_hash").alias(f"{side}_hash")), side)
    return out.select("a_id", "a_hash", "b_id", "b_hash", F.col("away").alias("distance"))


def link_counts(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class_id (smallest doc_id of equal shingles; a blank
    text's own id) and n_links, the number of other classes within RADIUS, of every row."""
    rows = shingle_rows(docs)
    classes = _classes(rows)
    pairs = _links(classes, docs)
    counts = (pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
              .groupBy("node").agg(F.count("*").alias("n_links")))
    counted = cut(classes.select("node", "digest", "label").join(counts, "node", "left")
                  .select("digest", "label", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")), "link-counts")
    return rows.select("doc_id", "n_shingles", "digest").join(counted, "digest").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("label")).otherwise(F.col("doc_id")).alias("class_id"),
        "n_links")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, the one of the smallest doc_id (then of the
    least text hash), with all its columns.

    Rows are told apart by id and text: rows that repeat an id with unlike texts
    are each judged in their own component, and of equal rows one stays.  Blank
    texts are components by id.  Rows without an id are judged apart from those
    with one: of each component one stays, also beside a row with an id; those with
    blank text stay.
    """
    no_id, own = F.col("doc_id").isNull(), F.when(F.col("n_shingles") == 0, F.col("doc_id"))
    group = ["component", "no_id", "own"]
    keys = (_placed(docs).filter("n_shingles > 0 or doc_id is not null")
            .groupBy("component", no_id.alias("no_id"), own.alias("own"), "doc_id", "text_hash")
            .agg(F.count("*").alias("n")))
    keys = cut(keys, "row-keys")
    first = cut(keys.groupBy(group).agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.count("*").alias("keys"))
                .filter("keys > 1").drop("keys"), "first-keys")
    keys = join_groups(keys, first, group, F.xxhash64("doc_id", "text_hash"), "left")
    stays = F.col("first").isNull() | F.struct("doc_id", "text_hash").eqNullSafe(F.col("first"))
    gone = cut(keys.withColumn("_repeated", stays).filter("not _repeated or n > 1")
               .select(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_hash"), "_repeated"), "not-kept")
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", F.xxhash64("text").alias("text_hash"))
    on = F.col("doc_id").eqNullSafe(F.col("_gone")) & (F.col("text_hash") == F.col("_hash"))
    if gone.count() <= BROADCAST_NODES:
        perhaps = rows.withColumn("_perhaps", _among(gone.select(F.col("_gone").alias("doc_id"), F.col("_hash").alias("text_hash")))
                                  ("doc_id", "text_hash"))
        others, rows = perhaps.filter("not _perhaps").select("_row.*"), perhaps.filter("_perhaps").drop("_perhaps")
    else:
        others = None
    rows = rows.join(gone, on, "left")
    rows = rows.filter("_hash is null or _repeated")
    once = (rows.filter("_hash is not null").groupBy("doc_id", "text_hash")
            .agg(F.min_by("_row", F.xxhash64(F.to_json("_row"))).alias("_row")))
    kept = rows.filter("_hash is null").select("_row.*").union(once.select("_row.*"))
    return kept if others is None else others.union(kept)
