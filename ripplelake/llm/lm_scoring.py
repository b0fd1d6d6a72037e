"""Language-model scoring from a log-frequency Bloom filter.

Counts c of word and word-pair n-grams are quantised to levels
``1 + floor(log_BASE c)``; an n-gram of level q is inserted q times, with its
level, into a Bloom filter, and read back by probing levels 1, 2, ... until one
is missing.  A pair's level is never read above its words' (a pair is no more
frequent than its parts), which also stops false positives.  Token
probabilities are Dirichlet-smoothed from those counts,

    p(w | h) = (c(h w) + MU p(w)) / (c(h) + MU),   p(w) = (c(w) + 0.1) / (M + 0.1 (V + 1)),

where all c are counts that levels stand for and M is their sum over the V words, so that
p(w) sums to 1 over the words and one unknown word.  The base score needs exact
word counts, which are kept beside the filter as sorted 64-bit word hashes and
counts; they also correct words' levels that a false positive raised, so only pairs' levels
(and the start context's) can be read too high: a pair of known words that never occurs
is read as seen in about 2.4 of 100 probes, which lets p(. | h) sum to
more than 1 by what those pairs hold.

Scale: tasks count n-grams of about a million tokens at a time, so a frequent
n-gram is one entry a task and chunk; entries are dealt by hash into
segments, and each segment merges its counts and builds its own piece of the
filter.  Segments follow the shuffle partitions, which follow the input.  The
model is broadcast up to ``BROADCAST_MB``.  For a larger one the texts are
written once as chunks of word numbers with the words' counts (a fraction of the
texts' size), and each of several passes reads the chunks, probes the pairs of a
group of segments and gives a sum for each text.  Logarithms are added up in
fixed point, so passes give the same result in any order.  All training texts are
counted and every text is scored whole.

Defined cases: null or empty text is the end token alone; rows without an id
are training texts; repeated rows count as often as they occur.  Without
training texts N and V are 0 and every token has the floor's probability 1.
An empty table gives an empty result.  Words are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import TEXTS, WordHashes, cut, fold, partitions, power_of_two, ship

ship(__name__)

FOLDS = 10
ADD = 0.1
BASE, MU = 1.5, 20.0
PROBES, BITS_AN_ENTRY = 4, 8
BROADCAST_MB = 160
CHUNK_TOKENS = 1 << 20
#: Chunks that go to a Python task at once, and tokens whose pairs are probed together.
FEW, BLOCK = 2, 1 << 17
#: Units in which logarithms are added up.
HIGH, LOW = 2.0 ** 20, 2.0 ** 50
WORD_CACHE = 300_000
#: Hashes of the end token and of the start context.
END, START = np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _scramble(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _pair(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _scramble(context * _ODD + word)


class Hasher:
    """Hashes of a text's tokens; remembers those of words."""

    def __init__(self) -> None:
        self.known = WordHashes()

    def __call__(self, text: bytes | None) -> np.ndarray:
        if len(self.known) > WORD_CACHE:
            self.known.clear()
        words = (text or b"").lower().split()
        return np.append(np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words)), END)


def levels_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(BASE) + 1e-9).astype(np.int64)


#: Count that a level stands for: the middle of those quantised to it.
def _middle(top: int) -> np.ndarray:
    q = np.arange(top + 1)
    low, high = np.ceil(BASE ** (q - 1.0) - 1e-9), np.ceil(BASE ** (q * 1.0) - 1e-9) - 1
    return np.where(q == 0, 0.0, (low + np.maximum(low, high)) / 2)


COUNT_OF_LEVEL = _middle(120)


def _places(keys: np.ndarray, level: int | np.ndarray, bits: np.ndarray) -> list[np.ndarray]:
    with np.errstate(over="ignore"):
        a = _scramble(keys + np.asarray(level, dtype=np.uint64) * _ODD)
        b = _scramble(a) | np.uint64(1)
        return [(a + np.uint64(k) * b) % bits for k in range(PROBES)]


def _merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(keys, return_inverse=True)
    return keys, np.bincount(at, weights=counts, minlength=len(keys)).astype(np.int64)


def _planes(x: np.ndarray) -> bytes:
    """The numbers' bytes, those of equal place together: what sorted or small numbers share compresses."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _numbers(planes: bytes, kind: str) -> np.ndarray:
    bytes_of = np.frombuffer(planes, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(bytes_of.T).view(kind).reshape(-1)


def _packed(x: np.ndarray) -> bytes:
    return pa.compress(_planes(x), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, n: int, kind: str) -> np.ndarray:
    return _numbers(pa.decompress(packed, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)


@dataclass
class Model:
    """Written segments of the filter and of the word counts, and the totals."""

    table: DataFrame  # segment, bits (filter size), filter, words, counts
    segments: int
    tokens: int  # N
    distinct: int  # V
    mass: float  # M
    filter_mb: float
    words_mb: float


def train(docs: DataFrame) -> Model:
    """Count all training texts and build the model's segments."""
    spark = docs.sparkSession
    segments = power_of_two(4 * partitions(spark))
    shift = np.uint64(64 - segments.bit_length() + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = Hasher(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            words = np.concatenate(held)
            first = np.cumsum([0] + [len(x) for x in held[:-1]])
            before = np.concatenate([[START], words[:-1]])
            before[first] = START
            rows = []
            contexts = np.append(words, np.full(len(held), START))
            for order, keys in ((1, contexts), (2, _pair(before, words))):
                keys, n = np.unique(keys, return_counts=True)
                cuts = np.searchsorted((keys >> shift).astype(np.int64), np.arange(segments + 1))
                rows += [(s, order, _planes(keys[a:b]), n[a:b].astype(np.uint32).tobytes())
                         for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
            names = ["segment", "order", "keys", "counts"]
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for b in batches:
            for t in b.column("text").cast(pa.binary()).to_pylist():
                held.append(hashes(t))
                size += len(held[-1])
                if size >= CHUNK_TOKENS:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    def build(t: pa.Table) -> pa.Table:
        got = {1: [], 2: []}
        for order, k, n in zip(*(t.column(c).to_pylist() for c in ("order", "keys", "counts"))):
            got[order].append((_numbers(k, "u8"), np.frombuffer(n, np.uint32)))
        keys, counts = [], []
        for parts in got.values():
            if parts:
                k, n = _merge(*(np.concatenate(x) for x in zip(*parts)))
            else:
                k, n = np.empty(0, np.uint64), np.empty(0, np.int64)
            keys.append(k)
            counts.append(n)
        q = levels_of(np.concatenate(counts))
        entries = int(q.sum())
        bits = np.uint64(max(64, -(-entries * BITS_AN_ENTRY // 64) * 64))
        table = np.zeros(int(bits), dtype=bool)
        everything = np.concatenate(keys)
        for level in range(1, int(q.max(initial=0)) + 1):
            for at in _places(everything[q >= level], level, bits):
                table[at.astype(np.int64)] = True
        words = keys[0] != START
        wide = int(counts[0].max(initial=0))
        return pa.table({"segment": [t.column("segment")[0].as_py()], "bits": [int(bits)],
                         "filter": [np.packbits(table, bitorder="little").tobytes()],
                         "words": [keys[0][words].tobytes()],
                         "counts": [counts[0][words].astype(np.uint32 if wide < 1 << 32 else np.uint64).tobytes()],
                         "n_words": [int(words.sum())], "n_tokens": [int(counts[0][words].sum())],
                         "mass": [float(COUNT_OF_LEVEL[levels_of(counts[0][words])].sum())]},
                        pa.schema([("segment", pa.int32()), ("bits", pa.int64()), ("filter", pa.binary()),
                                   ("words", pa.binary()), ("counts", pa.binary()), ("n_words", pa.int64()),
                                   ("n_tokens", pa.int64()), ("mass", pa.float64())]))

    texts = docs.filter(fold(F.col("doc_id"), FOLDS, 1) != 0).select("text")
    counted = texts.mapInArrow(count, "segment int, order int, keys binary, counts binary")
    built = counted.groupBy("segment").applyInArrow(
        build, "segment int, bits long, filter binary, words binary, counts binary, n_words long, n_tokens long, "
               "mass double")
    table = cut(built, "language-model", TEXTS)
    total = table.agg(F.sum("n_tokens"), F.sum("n_words"), F.sum(F.length("filter")),
                      F.sum(F.length("words") + F.length("counts")), F.sum(F.col("mass").cast("decimal(38,1)"))).first()
    n, v, f, w = (int(x or 0) for x in total[:4])
    return Model(table, segments, n, v, float(total[4] or 0), f / 1e6, w / 1e6)


class Part:
    """A group of a model's segments, as it is probed in a task: views of the broadcast bytes."""

    def __init__(self, held: tuple, segments: int) -> None:
        places, table, words, counts, kind = held
        self.shift = np.uint64(64 - segments.bit_length() + 1)
        self.offset = np.full(segments, -1, dtype=np.int64)
        self.bits = np.ones(segments, dtype=np.uint64)
        for s, bits, at in places:
            self.offset[s], self.bits[s] = at, bits
        self.table = np.frombuffer(table, dtype=np.uint8)
        self.words, self.counts = np.frombuffer(words, dtype=np.uint64), np.frombuffer(counts, dtype=kind)

    def exact(self, words: np.ndarray) -> np.ndarray:
        """Exact counts of words; 0 for those of other parts."""
        if not len(self.words):
            return np.zeros(len(words), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.counts[at].astype(np.int64), 0)

    def word_levels(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact counts of words and their levels, false positives put right; the start context has a level only."""
        exact, read = self.exact(words), self.levels(words)
        right = np.where(exact > 0, np.minimum(read, levels_of(exact)), 0)
        return exact, np.where(words == START, read, right)

    def levels(self, keys: np.ndarray, most: np.ndarray | None = None) -> np.ndarray:
        """Levels read by repeated probes; 0 for keys of other parts."""
        segment = (keys >> self.shift).astype(np.int64)
        start, bits = self.offset[segment], self.bits[segment]
        found = np.zeros(len(keys), dtype=np.int64)
        todo = np.flatnonzero(start >= 0)
        level = 0
        while len(todo):
            level += 1
            if most is not None:
                todo = todo[most[todo] >= level]
            hit = np.ones(len(todo), dtype=bool)
            for place in _places(keys[todo], level, bits[todo]):
                p = start[todo] + place.astype(np.int64)
                hit &= (self.table[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
            todo = todo[hit]
            found[todo] = level
        return found


def _groups(model: Model) -> list[list[int]]:
    passes = max(1, int(-(-(model.filter_mb + model.words_mb) // BROADCAST_MB)))
    return [list(range(model.segments))[i::passes] for i in range(passes)]


def _collected(model: Model, group: list[int] | None, pairs: bool = True, exact: bool = True) -> tuple:
    """A group's segments in order, at most about BROADCAST_MB: places in the
    filter, filter, sorted word hashes, their counts and the counts' type; without the
    filter unless ``pairs``, without words unless ``exact``."""
    places, table, words, counts = [], bytearray(), bytearray(), []
    none = F.lit(None).cast("binary")
    df = model.table if group is None else model.table.filter(F.col("segment").isin(group))
    for r in df.orderBy("segment").select("segment", "bits", *(F.col(c) if ok else none.alias(c) for c, ok in (
            ("filter", pairs), ("words", exact), ("counts", exact)))).toLocalIterator():
        if pairs:
            places.append((r[0], r[1], 8 * len(table)))
            table += r[2]
        if exact:
            words += r[3]
            counts.append(np.frombuffer(r[4], dtype=np.uint32 if 2 * len(r[4]) == len(r[3]) else np.uint64))
    counts = np.concatenate(counts) if counts else np.empty(0, np.uint32)
    return places, table, words, counts.tobytes(), counts.dtype.str


def _fixed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units of 2**-20 and of 2**-50 that values consist of; sums of them are exact."""
    high = np.floor(values * HIGH)
    return high.astype(np.int64), np.rint((values - high / HIGH) * LOW).astype(np.int64)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark, segments, total, distinct = docs.sparkSession, model.segments, model.tokens, model.distinct
    kind = dict(docs.dtypes)["doc_id"]
    floor, mass = total + ADD * (distinct + 1), model.mass + ADD * (distinct + 1)

    def read(part: Part, words: np.ndarray, before: np.ndarray) -> list[np.ndarray]:
        """Per token: exact count, level of the word, of its context, of the pair."""
        singles, back = np.unique(np.concatenate([words, before]), return_inverse=True)
        exact, level = part.word_levels(singles)
        w, h = back[:len(words)], back[len(words):]
        pairs, first, at = np.unique(_pair(before, words), return_index=True, return_inverse=True)
        return [exact[w], level[w], level[h], part.levels(pairs, np.minimum(level[w], level[h])[first])[at]]

    def logs(word: np.ndarray, context: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logarithms of tokens' probabilities, in fixed point."""
        c_word, c_context, c_pair = (COUNT_OF_LEVEL[x] for x in (word, context, pair))
        single = (c_word + ADD) / mass
        c_pair = np.minimum(np.minimum(c_pair, c_context), c_word)
        return _fixed(np.log10((c_pair + MU * np.minimum(single, 1)) / (c_context + MU)))

    def base(exact: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """Known tokens and base score of texts that begin at ``at``."""
        return [np.add.reduceat((exact > 0).astype(np.int64), at), np.add.reduceat(np.log10((exact + ADD) / floor), at)]

    schema = (f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double")
    rows = docs.select("doc_id", "text", (fold(F.col("doc_id"), FOLDS, 1) == 0).alias("held_out"))
    groups = _groups(model)
    if len(groups) == 1:
        shared = spark.sparkContext.broadcast(_collected(model, None))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, hashes = Part(shared.value, segments), Hasher()
            for whole in batches:
                for k in range(0, whole.num_rows, 200):
                    b = whole.slice(k, 200)
                    each = [hashes(t) for t in b.column("text").cast(pa.binary()).to_pylist()]
                    size = np.array([len(x) for x in each], dtype=np.int64)
                    words, at = np.concatenate(each), np.cumsum(size) - size
                    before = np.concatenate([[START], words[:-1]]).astype(np.uint64)
                    before[at] = START
                    exact, *levels = read(part, words, before)
                    high, low = (np.add.reduceat(x, at) for x in logs(*levels))
                    known, plain = base(exact, at)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id"), b.column("held_out"), pa.array(size), pa.array(known),
                         pa.array(np.full(len(size), total, dtype=np.int64)), pa.array(plain),
                         pa.array(high / HIGH + low / LOW)],
                        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        return cut(rows.mapInArrow(run, schema), "scores", TEXTS)

    # A model above the bound: chunks of word numbers, then a pass for each group of segments.
    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ids, held_out, each, n = Hasher(), [], [], [], 0

        def out() -> pa.RecordBatch:
            words, back, often = np.unique(np.concatenate(each), return_inverse=True, return_counts=True)
            order = np.argsort(-often, kind="stable")
            rank = np.empty(len(order), dtype=np.uint32)
            rank[order] = np.arange(len(order))
            size = np.array([len(x) for x in each], dtype=np.int64)
            none = np.zeros(len(words), dtype=np.uint64)
            listed = [pa.ListArray.from_arrays([0, len(size)], pa.concat_arrays(x)) for x in (ids, held_out)]
            return pa.RecordBatch.from_arrays(
                [*listed, *(pa.array([x], pa.binary()) for x in
                            (size.tobytes(), words[order].tobytes(), _packed(none), _packed(rank[back])))],
                ["ids", "held_out", "sizes", "words", "counts", "tokens"])

        for b in batches:
            first = 0
            for i, t in enumerate(b.column("text").cast(pa.binary()).to_pylist(), 1):
                each.append(hashes(t))
                n += len(each[-1])
                if n >= CHUNK_TOKENS or i == b.num_rows:
                    ids.append(b.column("doc_id").slice(first, i - first))
                    held_out.append(b.column("held_out").slice(first, i - first))
                    first = i
                if n >= CHUNK_TOKENS:
                    yield out()
                    ids, held_out, each, n = [], [], [], 0
        if each:
            yield out()

    def counted(shared: Broadcast) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = Part(shared.value, segments)
            for batch in batches:
                for i in range(batch.num_rows):
                    b = batch.slice(i, 1)
                    words = np.frombuffer(b.column("words")[0].as_buffer(), dtype=np.uint64)
                    counts = _unpacked(b.column("counts")[0].as_py(), len(words), "u8")
                    known = pa.array([_packed(np.maximum(counts, part.exact(words).astype(np.uint64)))], pa.binary())
                    yield b.set_column(b.schema.get_field_index("counts"), "counts", known)
        return run

    def chained(first: Callable, second: Callable) -> Callable:
        return lambda batches: second(first(batches))

    chunk = f"ids array<{kind}>, held_out array<boolean>, sizes binary, words binary, counts binary, tokens binary"
    passes = max(1, int(-(-model.words_mb // BROADCAST_MB)))
    chunks = rows
    for k in range(passes):
        shared = spark.sparkContext.broadcast(_collected(model, list(range(segments))[k::passes], pairs=False))
        step = counted(shared)
        chunks = chunks.mapInArrow(step if k else chained(numbered, step), chunk + ", chunk long" * bool(k))
        if not k:
            chunks = chunks.withColumn("chunk", F.monotonically_increasing_id())
        chunks = cut(chunks, "token-chunks", FEW if k else TEXTS)
        shared.destroy()
    start_at = int(START >> np.uint64(64 - segments.bit_length() + 1))
    start = int(Part(_collected(model, [start_at], exact=False), segments).levels(np.array([START]))[0])

    def summed(shared: Broadcast, group: list[int], whole: bool) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, mine = Part(shared.value, segments), np.zeros(segments, dtype=bool)
            mine[group] = True
            for batch in batches:
                for i in range(batch.num_rows):
                    b = batch.slice(i, 1)
                    size, words = (np.frombuffer(b.column(c)[0].as_buffer(), dtype=k) for c, k in
                                   (("sizes", np.int64), ("words", np.uint64)))
                    at = np.cumsum(size) - size
                    counts = _unpacked(b.column("counts")[0].as_py(), len(words), "u8").astype(np.int64)
                    word = _unpacked(b.column("tokens")[0].as_py(), int(size.sum()), "u4")
                    before = np.concatenate([[len(words)], word[:-1]]).astype(np.uint32)
                    before[at] = len(words)
                    hashes = np.append(words, START)
                    level = np.append(np.where(counts > 0, levels_of(counts), 0), start)
                    high, low = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
                    for k in range(0, len(word), BLOCK):
                        w, h = word[k:k + BLOCK], before[k:k + BLOCK]
                        pairs = _pair(hashes[h], hashes[w])
                        own = np.flatnonzero(mine[(pairs >> part.shift).astype(np.int64)])
                        of_word, of_context = level[w[own]], level[h[own]]
                        pair = part.levels(pairs[own], np.minimum(of_word, of_context))
                        high[k + own], low[k + own] = logs(of_word, of_context, pair)
                    n, texts = len(size), [pa.nulls(len(size), x) for x in kinds]
                    if whole:
                        known, plain = base(counts[word], at)
                        texts = [b.column("ids").flatten(), b.column("held_out").flatten(), pa.array(size),
                                 pa.array(known), pa.array(plain)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, b.column("chunk")[0].as_py())), pa.array(np.arange(n)), *texts,
                         pa.array(np.add.reduceat(high, at)), pa.array(np.add.reduceat(low, at))],
                        ["chunk", "at", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "high", "low"])
        return run

    kinds = [to_arrow_type(docs.schema["doc_id"].dataType), pa.bool_(), pa.int64(), pa.int64(), pa.float64()]
    sums = None
    for k, group in enumerate(groups):
        shared = spark.sparkContext.broadcast(_collected(model, group, exact=False))
        some = chunks if not k else chunks.drop("ids", "held_out")
        now = cut(some.mapInArrow(summed(shared, group, not k),
                                  f"chunk long, at long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, "
                                  "base_score double, high long, low long"), "text-sums", FEW)
        shared.destroy()
        sums = now if sums is None else sums.union(now)
    each = ("doc_id", "held_out", "n_tokens", "n_known", "base_score")
    out = sums.groupBy("chunk", "at").agg(*[F.max(c).alias(c) for c in each], F.sum("high").alias("high"), F.sum("low").alias("low"))
    return cut(out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score",
                          (F.col("high") / HIGH + F.col("low") / LOW).alias("score")), "scores", TEXTS)
