"""Best-fit packing planned on a histogram of lengths.

Texts are tokenised into pieces of at most ``CAPACITY`` ids.  Best-fit
decreasing runs over the histogram, not over documents: all pieces of one
length go into the bins of the tightest residual at once, whole groups of equal bins
at a time, so planning takes thousands of steps whatever the corpus holds.  Pieces then
take planned slots by their rank within their length.

Scale: texts are read once; the driver gets the histogram (at most CAPACITY
rows) and makes the plan, which is broadcast below ``BROADCAST_PLAN`` rows and
joined by length beyond.  Ranks come from ``running_sum``, so a length that a
third of all pieces share is spread over many tasks.

Defined cases: a null or empty text is the end id alone; only texts above
CAPACITY ids are cut; repeated rows and rows without an id are packed like any
other; equal rows take their ranks in any order.  An empty table gives no piece.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import TEXTS, cut, running_sum, ship

ship(__name__)

CAPACITY, END = 4096, 1
#: Plan rows (40 bytes each) that are broadcast.
BROADCAST_PLAN = 1_000_000
#: Pieces that a task remembers, and bytes of text that it encodes at once (a longer text at once, whole).
CACHE, SLICE = 600_000, 8 << 20
#: Words that are encoded whole: letters from U+0130, white space beyond ASCII's, special tokens.
WHOLE = r"[^\x00-\x{12F}]|[\x{85}\x{A0}]|<\|"


class Encoder:
    """Token ids of texts as little-endian bytes.

    The tokenizer drops white space and its pieces never span any, so a slice
    of texts is split into words by Arrow and each distinct word is encoded
    once.  Words below U+0130, where lower-casing goes letter by letter and
    nothing composes, are lower-cased and split into the tokenizer's own
    pieces by Arrow too; each distinct piece is encoded once while it is
    remembered.  Other words, those that may hold a special token, and all
    words of a tokenizer of another build are encoded whole.
    """

    def __init__(self, model: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.known = Tokenizer.from_str(model), {}
        content = json.loads(model)
        self.split = _piece_pattern(content)
        if self.split is None:
            return
        # Pieces are lower-case and apart already: what is left to do is to cut at blanks.
        steps = [{"type": "WhitespaceSplit"}, *content["pre_tokenizer"]["pretokenizers"][1:]]
        self.plain = Tokenizer.from_str(json.dumps(
            content | {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": steps}}))
        # Of a piece's ids just the last ends a word.
        suffix, vocabulary = content["model"].get("end_of_word_suffix") or "", content["model"]["vocab"]
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.last[[i for x, i in vocabulary.items() if suffix and x.endswith(suffix)]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, encoded as one text and cut at the ends of words."""
        if not pieces:
            return []
        ids = np.array(self.plain.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(pieces):
            return self._encode(pieces)
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *(4 * ends[:-1]).tolist()], (4 * ends).tolist())]

    def _by_pieces(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words, from the ids of their distinct pieces."""
        lower = pc.utf8_lower(words)
        mixed = pc.invert(pc.utf8_is_alpha(lower))
        apart = pc.replace_with_mask(lower, mixed, pc.replace_substring_regex(lower.filter(mixed), self.split, r"\0 "))
        split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(apart))
        flat = split.flatten().dictionary_encode()
        if len(self.known) > CACHE:
            self.known.clear()
        known, pieces = self.known, flat.dictionary.to_pylist()
        known[""] = b""
        new = [x for x in pieces if x not in known]
        known.update(zip(new, self._encode_pieces(new)))
        ids = pa.array([known[x] for x in pieces], pa.large_binary()).take(flat.indices)
        return _joined(ids, split.offsets)

    def _of_words(self, words: pa.Array) -> pa.Array:
        if self.split is None:
            return pa.array(self._encode(words.to_pylist()), pa.large_binary())
        whole = pc.match_substring_regex(words, WHOLE)
        odd = words.filter(whole)
        ids = self._by_pieces(words.filter(pc.invert(whole)))
        if not len(odd):
            return ids
        ids = pa.concat_arrays([ids, pa.array(self._encode(odd.to_pylist()), pa.large_binary())])
        # Back to the words' own order.
        return ids.take(pa.array(np.argsort(np.argsort(whole.to_numpy(zero_copy_only=False), kind="stable"))))

    def __call__(self, texts: pa.Array) -> Iterator[bytes]:
        end = np.array([END], dtype="<u4").tobytes()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        size = np.cumsum(pc.binary_length(texts).to_numpy()) if len(texts) else np.zeros(0, dtype=np.int64)
        start = 0
        while start < len(texts):
            done = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, done + SLICE, side="right")))
            split = pc.ascii_split_whitespace(texts.slice(start, stop - start))
            flat = split.flatten().dictionary_encode()
            for ids in _joined(self._of_words(flat.dictionary).take(flat.indices), split.offsets):
                yield ids.as_py() + end
            start = stop


def _joined(parts: pa.Array, offsets: pa.Array) -> pa.Array:
    """Consecutive binary values joined: value k holds the parts from offsets[k] to offsets[k + 1]."""
    if not len(parts):
        return pa.array([b""] * (len(offsets) - 1), pa.large_binary())
    at = np.frombuffer(parts.buffers()[1], dtype=np.int64)[parts.offset:parts.offset + len(parts) + 1]
    at = np.ascontiguousarray(at[offsets.to_numpy() - offsets[0].as_py()])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), parts.buffers()[2]])


def _piece_pattern(model: dict) -> str | None:
    """The tokenizer's own split pattern, if it lower-cases, drops what lies
    between the pattern's matches and encodes each match alone."""
    steps = [x.get("type") for x in (model.get("normalizer") or {}).get("normalizers", [])]
    first = ((model.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    if steps != ["NFC", "Replace", "Lowercase"] or (first.get("type"), first.get("behavior"), first.get("invert")) != (
            "Split", "Removed", True):
        return None
    return first["pattern"]["Regex"]


def tokenizer_model(path: str | None = None) -> str:
    """The tokenizer file's content; by default the public word-level BPE."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def pieces(docs: DataFrame, model: str, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, text_hash, piece, start, length, ids_crc32 (and ids)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)["doc_id"]
    width = 4 * CAPACITY

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(shared.value)
        for b in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, x in enumerate(encode(b.column("text"))):
                for k, a in enumerate(range(0, len(x), width)):
                    part = x[a:a + width]
                    row.append(i)
                    piece.append(k)
                    start.append(a // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(at), b.column("text_hash").take(at), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                + [pa.array(ids, pa.binary())] * with_ids,
                ["doc_id", "text_hash", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    schema = f"doc_id {kind}, text_hash long, piece int, start long, length long, ids_crc32 long"
    return cut(rows.mapInArrow(run, schema + ", ids binary" * with_ids), "pieces", TEXTS)


def plan_slots(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Rows (length, first rank, end rank, first sequence, pieces a sequence,
    offset): the piece of rank r goes to sequence first + (r - first rank) //
    pieces, at offset + (r - first rank) % pieces * length.
    """
    rows: list[tuple[int, int, int, int, int, int]] = []
    free: dict[int, list[tuple[int, int]]] = {}  # residual -> groups of bins (first sequence, bins)
    residuals: list[int] = []
    opened = 0

    def leave(residual: int, first: int, bins: int) -> None:
        if residual and bins:
            if residual not in free:
                free[residual] = []
                insort(residuals, residual)
            free[residual].append((first, bins))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(residuals, length)
            if at < len(residuals):
                residual = residuals[at]
                first, bins = free[residual].pop()
                if not free[residual]:
                    del free[residual], residuals[at]
            else:
                residual, first = capacity, opened
                bins = -(-left // (capacity // length))
                opened += bins
            each = residual // length
            full = min(bins, left // each)
            if full:
                rows.append((length, rank, rank + full * each, first, each, capacity - residual))
                leave(residual - each * length, first, full)
                rank, left, first, bins = rank + full * each, left - full * each, first + full, bins - full
            if left and left < each and bins:
                rows.append((length, rank, rank + left, first, left, capacity - residual))
                leave(residual - left * length, first, 1)
                rank, left, first, bins = rank + left, 0, first + 1, bins - 1
            leave(residual, first, bins)
    return rows


def take_slots(ranked: DataFrame, rows: list[tuple[int, int, int, int, int, int]]) -> DataFrame:
    """Add sequence_id and offset to pieces with their ``rank`` within their length."""
    spark = ranked.sparkSession
    if len(rows) > BROADCAST_PLAN:
        names = ["_length", "_low", "_high", "_first", "_each", "_offset"]
        planned = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in names))
        within = F.col("rank") - F.col("_low")
        return ranked.join(planned, (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("_low"))
                           & (F.col("rank") < F.col("_high"))).withColumns({
            "sequence_id": F.col("_first") + F.floor(within / F.col("_each")).cast("long"),
            "offset": F.col("_offset") + within % F.col("_each") * F.col("length")}).drop(*names)
    shared = spark.sparkContext.broadcast(np.array(sorted(rows), dtype=np.int64).reshape(-1, 6))
    schema = T.StructType([*ranked.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        key = p[:, 0] * (1 << 48) + p[:, 1]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            r = p[np.searchsorted(key, length * (1 << 48) + rank, side="right") - 1] if b.num_rows else p[:0]
            within = rank - r[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(r[:, 3] + within // np.maximum(r[:, 4], 1)),
                 pa.array(r[:, 5] + within % np.maximum(r[:, 4], 1) * length)],
                [*b.schema.names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, schema)


def pack(docs: DataFrame, model: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece (and ids)."""
    rows = pieces(docs, model or tokenizer_model(), with_ids)
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    ranked = running_sum(rows.withColumn("one", F.lit(1)), ["length"], ["doc_id", "text_hash", "piece"], "one", "rank")
    return take_slots(ranked.drop("one"), plan_slots(histogram)).drop("text_hash", "rank")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids (little-endian unsigned 32-bit) of packed pieces with ids, at most CAPACITY ids a row."""
    part = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(part.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
