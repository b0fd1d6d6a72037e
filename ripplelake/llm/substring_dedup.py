"""Substring dedup with a compressed FM-index per shard.

A window is ``WINDOW`` consecutive words of one document.  A word is removed
if a window covers it whose word sequence also starts earlier, in a smaller
doc_id or earlier in the same document; windows are judged on the input.

Dealing.  Streaming every document past every shard would grow with the square
of the corpus.  Windows are dealt by content instead: a window's anchor is the
least hash of its ``GRAM``-word grams, equal windows have equal anchors, and
consecutive windows of one anchor form a segment (some 9 windows).  Every window
lies in exactly one segment, and all places of a window have segments of one
anchor.  Segments whose anchor no other segment has can't hold a repeat and go
no further.  Equal segments are one from here on, with the number of their
places and the first one; copies therefore cost an index one segment.

Index and search.  Anchors are dealt to shards that follow the number of words;
a shard's segments, in document order, become an FM-index (``fm_index``),
written as a compressed blob.  The segments are then streamed past their
shard's index: matching statistics by backward search, up to ``WINDOW`` words
back from every word; those that reach ``WINDOW`` with two places or more are
repeats, and the index gives the first place.  An anchor with more than
``HOT`` different segments (a passage's border within very many documents)
would be one large group: its windows are dealt one by one, equal ones added
up before they meet.  ``spans`` returns the marked windows,
``intervals`` joins them, ``dedup`` removes their words.

Bounded memory: tasks hold a batch of texts, or one shard.  A bitmap of
``BITMAP`` bits (8 MB at any size) tells anchors and documents that surely need
no work from the others; false hits cost work only.

Defined cases: null text has no words; texts of fewer than WINDOW words are
kept whole.  Rows without an id come after those with one.  Rows that share an
id are ordered by a hash of their text; rows that repeat both id and text are
one document, given several times, and get the same result.  An empty table
gives an empty result; other columns pass through ``dedup`` untouched.  Words
are known by 64-bit hashes; windows are compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, partitions, ship
from .fm_index import FMIndex

ship(__name__)

WINDOW, GRAM = 20, 4
#: Windows of a segment at most: one bit each.
MOST = 63
HOT = 512
SHARD_WORDS = 1 << 18
BITMAP = 1 << 26
#: Texts that a task hashes at once.
SOME = 300
_ODD, _MORE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BACK = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
#: Masks of the first 0 to 8 bytes; the bytes that end a word.
_FIRST = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=np.uint64)
_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * _ODD
        return x ^ (x >> np.uint64(29))


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes end to end and each text's first place; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return flat[ends[0]:ends[-1]], ends - ends[0]


def word_places(flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of all words, and the number of words of each text."""
    solid = ~_WHITE[flat]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    edge = ends[1:-1][(ends[1:-1] > 0) & (ends[1:-1] < len(flat))]  # words of neighbouring texts may touch
    first[edge] = solid[edge]
    last[edge - 1] = solid[edge - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1 - start, np.diff(np.searchsorted(start, ends))


def hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the texts' words, end to end, and the number of each text."""
    flat, ends = _bytes_of(texts)
    start, size, n = word_places(flat, ends)
    padded = np.concatenate([flat, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(flat) + 1, dtype="<u8", buffer=padded, strides=(1,))  # the eight bytes from each place on
    out = _mix(size.astype(np.uint64))
    rest, left = np.arange(len(start)), size
    with np.errstate(over="ignore"):
        while len(rest):
            part = eight[start] & _FIRST[np.minimum(left, 8)]
            out[rest] = _mix((out[rest] ^ part) * _MORE)
            more = left > 8
            rest, start, left = rest[more], start[more] + 8, left[more] - 8
    return out, n


def _window_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every n consecutive values."""
    k = 1
    while k < n:
        step = min(k, n - k)
        x = np.minimum(x[:-step], x[step:])
        k += step
    return x


def _run_hash(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of words[start:start + size], for each pair."""
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(len(words) + 1, _MORE))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(words) * power[:-1], dtype=np.uint64)])
        back = np.cumprod(np.full(len(words) + 1, _BACK))
        return _mix((sums[start + size] - sums[start]) * back[start] + size.astype(np.uint64) * _ODD)


def segments(words: np.ndarray, size: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(document, start, windows, anchor, content hash) of the segments of documents that lie end to end."""
    if len(words) < window:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, np.uint64), np.empty(0, np.uint64)
    gram = min(GRAM, window)
    with np.errstate(over="ignore"):
        grams = np.zeros(len(words) - gram + 1, dtype=np.uint64)
        for j in range(gram):
            grams = grams * _MORE + words[j:len(words) - gram + 1 + j]
    grams = _mix(grams)
    least = _window_min(grams, window - gram + 1)
    doc = np.repeat(np.arange(len(size)), size)
    whole = np.flatnonzero(doc[:len(least)] == doc[window - 1:])  # windows inside one document
    anchor, owner = least[whole], doc[whole]
    new = np.ones(len(whole), dtype=bool)
    # A segment also ends where the window leaves its anchor's first place, so it holds no window twice.
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | (grams[whole[:-1]] == anchor[:-1])
    run = np.flatnonzero(new)
    within = np.arange(len(whole)) - np.repeat(run, np.diff(np.append(run, len(whole))))
    first = np.flatnonzero(within % MOST == 0)
    n = np.diff(np.append(first, len(whole)))
    at = whole[first]
    begins = np.cumsum(size) - size
    return owner[first], at - begins[owner[first]], n, anchor[first], _run_hash(words, at, n + window - 1)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _bits(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys.view(np.uint64)) >> np.uint64(20)).astype(np.int64) & (BITMAP - 1)


def bitmap(df: DataFrame, key: str) -> bytes:
    """A bitmap of BITMAP bits with the bit of every key set."""
    chunk = 1 << 16

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(_bits(b.column(0).to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array((at // chunk).astype(np.int32)),
                                              pa.array((at % chunk).astype(np.int32))], ["chunk", "bit"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            chunks, bit = b.column("chunk").to_numpy(), b.column("bit").to_numpy()
            for k in np.unique(chunks):
                held.setdefault(int(k), np.zeros(chunk, dtype=bool))[bit[chunks == k]] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.array([np.packbits(x).tobytes() for x in held.values()], pa.binary())],
            ["chunk", "bits"])

    rows = df.select(key).mapInArrow(place, "chunk int, bit int")
    rows = rows.repartition(partitions(df.sparkSession), "chunk").mapInArrow(fill, "chunk int, bits binary")
    out = np.zeros(BITMAP // 8, dtype=np.uint8)
    for r in rows.collect():  # BITMAP bits in all
        out[r.chunk * chunk // 8:(r.chunk + 1) * chunk // 8] |= np.frombuffer(r.bits, dtype=np.uint8)
    return out.tobytes()


def _held(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = _bits(keys)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def _in_bitmap(bits, key: str) -> Column:
    @F.arrow_udf("boolean")
    def test(k: pa.Array) -> pa.Array:
        return pa.array(_held(np.frombuffer(bits.value, dtype=np.uint8), k.to_numpy(zero_copy_only=False)))

    return test(key)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, text_hash and a 64-bit key of the two."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return rows.withColumn("doc_key", F.xxhash64("doc_id", "text_hash"))


def _place(doc_id: str = "doc_id") -> Column:
    return F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("doc_id"), "text_hash", "start")


def _segment_rows(docs: DataFrame, window: int) -> DataFrame:
    """Every document's segments, a row per document that has one."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, size = hashed(b.column("text"))
            doc, start, n, anchor, content = segments(words, size, window)
            ends = np.flatnonzero(np.diff(doc, append=-1)) + 1
            some = doc[ends - 1] if len(doc) else np.empty(0, np.int64)
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (
                pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), _signed(anchor), _signed(content))]
            yield pa.RecordBatch.from_arrays([b.column(c).take(pa.array(some)) for c in ("doc_id", "text_hash", "doc_key")]
                                             + lists, ["doc_id", "text_hash", "doc_key", "start", "n", "anchor", "content"])

    kinds = f"doc_id {kind}, text_hash long, doc_key long, start array<int>, n array<int>, anchor array<long>, content array<long>"
    return cut(docs.mapInArrow(run, kinds), "segments", SOME)


def _suspects(rows: DataFrame) -> DataFrame:
    """Segments whose anchor occurs twice or more (and a few others)."""
    spark = rows.sparkSession
    kind = dict(rows.dtypes)["doc_id"]
    anchors = rows.select(F.explode("anchor").alias("anchor")).groupBy("anchor").count().filter("count > 1")
    bits = spark.sparkContext.broadcast(bitmap(anchors, "anchor"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_hash", "doc_key"]
        for b in batches:
            flat = {c: b.column(c).flatten() for c in ("start", "n", "anchor", "content")}
            size = np.diff(b.column("start").offsets.to_numpy())
            keep = np.flatnonzero(_held(np.frombuffer(bits.value, dtype=np.uint8), flat["anchor"].to_numpy()))
            owner = pa.array(np.repeat(np.arange(b.num_rows), size)[keep])
            keep = pa.array(keep)
            yield pa.RecordBatch.from_arrays([b.column(c).take(owner) for c in names]
                                             + [x.take(keep) for x in flat.values()], names + list(flat))

    kinds = f"doc_id {kind}, text_hash long, doc_key long, start int, n int, anchor long, content long"
    return cut(rows.mapInArrow(run, kinds), "suspects")


def _texts_of(docs: DataFrame, contents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text, wanted): the documents whose words ``contents`` need, with the list of those."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(contents, "doc_key"))
    wanted = contents.groupBy("doc_key", "text_hash").agg(
        F.collect_list(F.struct("anchor", "content", "start", "n")).alias("wanted"))
    texts = docs.filter(_in_bitmap(bits, "doc_key")).dropDuplicates(["doc_key", "text_hash"])
    return texts.join(wanted, ["doc_key", "text_hash"]).select("doc_id", "text_hash", "text", "wanted")


def _wanted(b: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Word hashes of the batch, the first of every wanted segment, its row, anchor, content, start and windows."""
    words, size = hashed(b.column("text"))
    want = b.column("wanted")
    owner = np.repeat(np.arange(b.num_rows), np.diff(want.offsets.to_numpy()))
    anchor, content, start, n = (x.to_numpy() for x in want.flatten().flatten())
    return words, (np.cumsum(size) - size)[owner] + start, owner, anchor, content, start, n


def _segment_words(docs: DataFrame, contents: DataFrame, window: int) -> DataFrame:
    """One place of every content, with its words."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, at, owner, anchor, content, start, n = _wanted(b)
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(content), b.column("doc_id").take(rows), b.column("text_hash").take(rows),
                 pa.array(start), pa.array([words[i:i + k].tobytes() for i, k in zip(at, n + window - 1)], pa.binary())],
                ["anchor", "content", "doc_id", "text_hash", "start", "words"])

    return _texts_of(docs, contents).mapInArrow(
        run, f"anchor long, content long, doc_id {kind}, text_hash long, start int, words binary")


def _hot_windows(docs: DataFrame, contents: DataFrame, window: int) -> DataFrame:
    """Every window of the contents, by itself: its hash and its number in the segment."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, at, owner, anchor, content, start, n = _wanted(b)
            shift = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at, rows = np.repeat(at, n) + shift, pa.array(np.repeat(owner, n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(anchor, n)), pa.array(np.repeat(content, n)), pa.array(shift.astype(np.int32)),
                 _signed(_run_hash(words, at, np.full(len(at), window))), b.column("doc_id").take(rows),
                 b.column("text_hash").take(rows), pa.array((np.repeat(start, n) + shift).astype(np.int32))],
                ["anchor", "content", "shift", "whole", "doc_id", "text_hash", "start"])

    return cut(_texts_of(docs, contents).mapInArrow(
        run, f"anchor long, content long, shift int, whole long, doc_id {kind}, text_hash long, start int"), "hot-windows", SOME)


def matching_statistics(words: list[np.ndarray], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, start, first): repeated windows of sequences that stand in document order, each
    sequence's windows streamed past the index of all; ``first`` tells whether it is the first place."""
    index = FMIndex(words, window)
    size = np.array([len(x) for x in words], dtype=np.int64)
    symbols = np.full(int(size.sum()) + len(size), -1, dtype=np.int64)
    symbols[np.arange(int(size.sum())) + np.repeat(np.arange(1, len(size) + 1), size)] = index.symbols(np.concatenate(words))
    n = np.maximum(0, size - window + 1)
    owner = np.repeat(np.arange(len(n)), n)
    shift = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    place = index.starts[owner] + shift
    matched, low, _ = index.matching(symbols, place + window, least=2)
    again = np.flatnonzero(matched == window)
    return owner[again], shift[again], index.first_place(low[again]) == place[again]


def _masks(pieces: DataFrame, shards: int, window: int) -> DataFrame:
    """(anchor, content, mask): windows of every content that start earlier too, a bit each."""
    def search(t: pa.Table) -> pa.Table:
        t = t.sort_by([(c, "ascending") for c in ("no_id", "doc_id", "text_hash", "start")])
        owner, shift, first = matching_statistics([np.frombuffer(x, dtype=np.uint64) for x in t["words"].to_pylist()], window)
        mask = np.zeros(t.num_rows, dtype=np.int64)
        np.bitwise_or.at(mask, owner[~first], np.int64(1) << shift[~first])
        held = np.flatnonzero(mask)
        return pa.table({"anchor": t["anchor"].take(pa.array(held)), "content": t["content"].take(pa.array(held)),
                         "mask": pa.array(mask[held])})

    dealt = pieces.withColumns({"no_id": F.col("doc_id").isNull(), "shard": F.pmod(F.xxhash64("anchor"), F.lit(shards))})
    return dealt.groupBy("shard").applyInArrow(search, "anchor long, content long, mask long")


def spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, doc_key, start, mask): bit j of mask tells that the
    window at start + j also starts earlier; segments without one are left out."""
    spark, docs = docs.sparkSession, _keyed(docs)
    places = _suspects(_segment_rows(docs, window))
    contents = places.groupBy("anchor", "content").agg(
        F.min(_place()).alias("first"), F.max("n").alias("n"), F.count("*").alias("places"))
    contents = cut(contents, "contents")
    groups = contents.groupBy("anchor").agg(F.count("*").alias("k"), F.sum("places").alias("p")).filter("p > 1")
    contents = contents.join(groups, "anchor").select(
        "anchor", "content", "first", "first.*", "n", "places", (F.col("k") > HOT).alias("hot"))
    contents = cut(contents.withColumn("doc_key", F.xxhash64("doc_id", "text_hash")), "repeated-contents")
    few, many = contents.filter("not hot"), contents.filter("hot")

    total = few.agg(F.sum(F.col("n") + (window - 1))).first()[0] or 0
    shards = max(4 * partitions(spark), -(-int(total) // SHARD_WORDS))
    masks = cut(_masks(_segment_words(docs, few, window), shards, window), "masks")
    if not many.isEmpty():
        windows = _hot_windows(docs, many, window)
        seen = windows.groupBy("anchor", "whole").agg(F.min(_place()).alias("earliest"))
        windows = windows.join(seen, ["anchor", "whole"]).filter(_place() != F.col("earliest"))
        masks = masks.unionByName(windows.groupBy("anchor", "content").agg(F.bit_or(F.expr("shiftleft(1L, shift)")).alias("mask")))
    marked = contents.select("anchor", "content", "places", "first").join(masks, ["anchor", "content"], "left")
    # Written first, so that the join below has its own exchanges and a content with very many places can be split.
    marked = cut(marked.filter("places > 1 or mask is not null"), "marked-contents")
    every = F.expr("~shiftleft(-1L, n)")
    marked = places.join(marked, ["anchor", "content"]).withColumn(
        "mask", F.when(_place() == F.col("first"), F.col("mask")).otherwise(every))
    return cut(marked.filter("mask is not null").select("doc_id", "text_hash", "doc_key", "start", "mask"), "spans")


def _covered(n: int, spans: list[dict] | None, window: int) -> np.ndarray:
    """Which of n words the spans' windows cover."""
    edge = np.zeros(n + 1, dtype=np.int64)
    if spans:
        start = np.array([s["start"] for s in spans], dtype=np.int64)
        mask = np.array([s["mask"] for s in spans], dtype=np.int64)
        of, bit = np.nonzero((mask[:, None] >> np.arange(MOST)) & 1)
        at = start[of] + bit
        np.add.at(edge, at, 1)
        np.add.at(edge, at + window, -1)
    return np.cumsum(edge)[:n] > 0


def intervals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, start, length): maximal runs of words that windows found earlier cover."""
    marked = spans(docs, window)

    @F.arrow_udf("array<struct<start:int,length:int>>")
    def runs(held: pa.Array) -> pa.Array:
        out = []
        for x in held.to_pylist():
            edge = np.diff(_covered(max(s["start"] for s in x) + MOST + window, x, window).astype(np.int8), prepend=0, append=0)
            begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            out.append([{"start": int(a), "length": int(b - a)} for a, b in zip(begin, end)])
        return pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())])))

    lists = marked.groupBy("doc_key", "text_hash").agg(F.first("doc_id").alias("doc_id"),
                                                       F.collect_set(F.struct("start", "mask")).alias("held"))
    return lists.select("doc_id", "text_hash", F.inline(runs("held")))


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, ``text`` without repeated words (kept words joined by one
    space), with ``n_words`` and ``n_removed`` (columns of these names are replaced)."""
    marked = spans(docs, window)
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(marked, "doc_key"))
    made = pa.struct([("text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())])

    def clean(texts: pa.Array, held: list | None) -> pa.Array:
        kept, n_words, n_removed = [], [], []
        for i, t in enumerate(texts.cast(pa.binary()).to_pylist()):
            words = (t or b"").split()
            n_words.append(len(words))
            if held and held[i]:
                gone = _covered(len(words), held[i], window)
                words = [w for w, g in zip(words, gone.tolist()) if not g]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words))
        return pa.StructArray.from_arrays([pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_words, pa.int64()),
                                           pa.array(n_removed, pa.int64())], fields=list(made))

    # Test and work in one function: a task needs one Python worker.
    @F.arrow_udf("text string, n_words long, n_removed long")
    def if_clear(keys: pa.Array, texts: pa.Array) -> pa.Array:
        clear = np.flatnonzero(~_held(np.frombuffer(bits.value, dtype=np.uint8), keys.to_numpy()))
        place = np.full(len(keys), -1, dtype=np.int64)
        place[clear] = np.arange(len(clear))
        return clean(texts.take(pa.array(clear)), None).take(pa.array(place, mask=place < 0))

    @F.arrow_udf("text string, n_words long, n_removed long")
    def without(texts: pa.Array, held: pa.Array) -> pa.Array:
        return clean(texts, held.to_pylist())

    rows = docs.select(F.struct("*").alias("_row"), F.xxhash64("text").alias("text_hash"))
    rows = rows.withColumn("doc_key", F.xxhash64("_row.doc_id", "text_hash"))
    lists = marked.groupBy("doc_key", "text_hash").agg(F.collect_set(F.struct("start", "mask")).alias("_spans"))
    hit = rows.filter(_in_bitmap(bits, "doc_key")).join(lists, ["doc_key", "text_hash"], "left")
    if_clear = if_clear.asNondeterministic()  # else the filter would evaluate it once more
    rows = (rows.select("_row", if_clear("doc_key", "_row.text").alias("_new")).filter("_new is not null")
            .union(hit.select("_row", without("_row.text", "_spans"))))
    new = ("text", "n_words", "n_removed")
    own = [F.col(f"_new.{c}") if c in new else F.col(f"_row.`{c}`") for c in docs.columns]
    return rows.select(*own, *[F.col(f"_new.{c}") for c in new if c not in docs.columns])
