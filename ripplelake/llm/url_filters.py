"""URL filters: exact membership by a cascade of Bloom filters.

The complete key universe of the corpus is known, so membership in a list can
be made exact: level 1 encodes the listed keys; level 2 encodes the unlisted
keys of the universe that level 1 lets through; level 3 the listed ones that level 2
lets through, and so on until nothing is left to tell apart.  A key's answer
is the parity of the first level that doesn't hold it.  No join is needed to
ask.

Scale: keys are dealt by hash into segments, and each segment builds its own
whole cascade in one task (hashes spread evenly, whatever hosts repeat).  The
segments are broadcast up to ``BROADCAST_MB``; larger cascades are asked in
passes, a group of segments at a time, over a written table.

Defined cases: a null URL or one without ``://`` has an empty host and path,
which no rule fits, and is a key of the universe like any other; rows are judged one by one,
so repeated rows and null ids keep their answers.  An empty universe or list
gives a cascade that lists nothing.  Keys are told apart by 128 bits of hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, lower_ascii, partitions, power_of_two, ship

ship(__name__)

#: Rules (verdict, host, path), fixed values.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
BROADCAST_MB, MAX_LEVELS = 128, 64


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def _hashes(key: Column) -> dict[str, Column]:
    return {"h1": F.xxhash64(key), "h2": F.xxhash64(key, F.lit(1))}


def _places(h1: np.ndarray, h2: np.ndarray, level: int, probes: int, bits: int) -> Iterator[np.ndarray]:
    with np.errstate(over="ignore"):
        a = h1 * np.uint64(0x9E3779B97F4A7C15) + h2 * np.uint64(2 * level + 1)
        a = (a ^ (a >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        step = (h2 ^ (a >> np.uint64(29))) | np.uint64(1)
        for k in range(probes):
            yield ((a + np.uint64(k) * step) % np.uint64(bits)).astype(np.int64)


class Level:
    """One Bloom filter of a cascade."""

    def __init__(self, level: int, probes: int, bits: int, table: np.ndarray) -> None:
        self.level, self.probes, self.bits, self.table = level, probes, bits, table

    @classmethod
    def of(cls, keys: np.ndarray, others: int, level: int) -> Level:
        rate = 0.5 if level > 1 else min(0.5, len(keys) / max(1.0, math.sqrt(2) * others))
        rate = max(rate, 1e-6)
        probes = max(1, round(math.log2(1 / rate)))
        bits = max(64, 8 * math.ceil(len(keys) * probes / math.log(2) / 8))
        table = np.zeros(bits, dtype=bool)
        for at in _places(keys[:, 0], keys[:, 1], level, probes, bits):
            table[at] = True
        return cls(level, probes, bits, np.packbits(table, bitorder="little"))

    def holds(self, keys: np.ndarray) -> np.ndarray:
        hit = np.ones(len(keys), dtype=bool)
        for at in _places(keys[:, 0], keys[:, 1], self.level, self.probes, self.bits):
            hit &= (self.table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return hit


def cascade_of(listed: np.ndarray, unlisted: np.ndarray) -> list[Level]:
    """Levels that tell listed from unlisted keys (rows of two 64-bit hashes)."""
    levels: list[Level] = []
    keep, rest = listed, unlisted
    while len(keep):
        if len(levels) >= MAX_LEVELS:
            raise ValueError("keys of both kinds share all 128 bits of hash")
        levels.append(Level.of(keep, len(rest), len(levels) + 1))
        keep, rest = rest[levels[-1].holds(rest)], keep
    return levels


def listed_by(levels: list[Level], keys: np.ndarray) -> np.ndarray:
    """Whether keys of the universe are listed: the parity of the first level that doesn't hold them."""
    answer = np.full(len(keys), len(levels) % 2 == 1)
    todo = np.arange(len(keys))
    for i, level in enumerate(levels):
        hit = level.holds(keys[todo])
        answer[todo[~hit]] = i % 2 == 1
        todo = todo[hit]
    return answer


def build(universe: DataFrame) -> tuple[DataFrame, int]:
    """Cascades by segment from (key, listed) rows; repeated keys are one key,
    listed if any of its rows is."""
    segments = power_of_two(partitions(universe.sparkSession))
    rows = (universe.select(*[c.alias(n) for n, c in _hashes(F.col("key")).items()], "listed")
            .groupBy("h1", "h2").agg(F.bool_or("listed").alias("listed"))
            .withColumn("segment", _segment(F.col("h1"), segments)))

    def run(t: pa.Table) -> pa.Table:
        keys = np.stack([t.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2")], 1)
        listed = t.column("listed").to_numpy(zero_copy_only=False).astype(bool)
        levels = cascade_of(keys[listed], keys[~listed])
        n = len(levels)
        return pa.table({"segment": pa.array(np.full(n, t.column("segment")[0].as_py()), pa.int32()),
                         "level": pa.array([x.level for x in levels], pa.int32()),
                         "probes": pa.array([x.probes for x in levels], pa.int32()),
                         "bits": pa.array([x.bits for x in levels], pa.int64()),
                         "filter": pa.array([x.table.tobytes() for x in levels], pa.binary())})

    built = rows.groupBy("segment").applyInArrow(run, "segment int, level int, probes int, bits long, filter binary")
    return cut(built, "cascade"), segments


def _segment(h1: Column, segments: int) -> Column:
    return (F.shiftrightunsigned(h1, 65 - segments.bit_length()) if segments > 1 else F.lit(0)).cast("int")


def ask(df: DataFrame, key: Column, cascade: DataFrame, segments: int, out: str = "listed") -> DataFrame:
    """Add whether ``key``, of the cascade's universe, is listed."""
    spark = df.sparkSession
    size = cascade.agg(F.coalesce(F.sum(F.length("filter")), F.lit(0))).first()[0] / 1e6
    passes = max(1, math.ceil(size / BROADCAST_MB))
    rows = df.withColumns({f"_{n}": c for n, c in _hashes(key).items()} | {out: F.lit(None).cast("boolean")})
    rows = rows.withColumn("_segment", _segment(F.col("_h1"), segments))
    schema = T.StructType(rows.schema.fields)
    place = rows.columns.index(out)
    for turn in range(passes):
        group = cascade if passes == 1 else cascade.filter(F.col("segment") % passes == turn)
        shared = spark.sparkContext.broadcast([(r[0], r[1], r[2], r[3], bytes(r[4])) for r in group.toLocalIterator()])

        def run(batches: Iterator[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:
            levels: dict[int, list[Level]] = {}
            for s, level, probes, bits, packed in sorted(shared.value):
                levels.setdefault(s, []).append(Level(level, probes, bits, np.frombuffer(packed, np.uint8)))
            for b in batches:
                keys = np.stack([b.column(c).to_numpy().view(np.uint64) for c in ("_h1", "_h2")], 1)
                segment = b.column("_segment").to_numpy()
                answer = np.array([bool(x) for x in b.column(out).to_pylist()], dtype=bool)
                order = np.argsort(segment, kind="stable")
                cuts = np.flatnonzero(np.diff(segment[order])) + 1
                for at in np.split(order, cuts):
                    if len(at) and segment[at[0]] % passes == turn:
                        answer[at] = listed_by(levels.get(int(segment[at[0]]), []), keys[at])
                columns = list(b.columns)
                columns[place] = pa.array(answer)
                yield pa.RecordBatch.from_arrays(columns, b.schema.names)

        rows = rows.mapInArrow(run, schema)
        rows = rows if passes == 1 else cut(rows, "asked")
    return rows.drop("_h1", "_h2", "_segment")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every row.

    The universe is every (host, path) of the table; listed are those that a
    block rule decides.  Every verdict is the cascade's answer.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    key = F.concat_ws("\n", "host", "path")
    cascade, segments = build(rows.select(key.alias("key"), F.coalesce(verdict == "block", F.lit(False)).alias("listed")))
    asked = ask(rows.withColumn("rule", rule), key, cascade, segments)
    return asked.select("page_id", "host", "path", "rule",
                        F.when(F.col("listed"), F.lit("block")).otherwise("allow").alias("verdict"))
