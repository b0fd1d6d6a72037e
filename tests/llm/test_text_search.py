"""Substring dedup, phrase mining and impact search against brute force: nulls, empty and long texts, ties,
repeated rows, empty tables and columns with clashing names."""
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

from ripplelake.llm import fm_index, impact_search, phrase_mining, substring_dedup
from ripplelake.llm.common import table
from ripplelake.session import scratch_path

from test_operators import DOCS, sample

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(sample(seed=5), DOCS).withColumns(
        {c: F.lit(i) for i, c in enumerate(["n_words", "start", "mask", "text_hash", "doc_key", "_row", "terms", "f", "lang_"])})
    path = scratch_path(spark, "sample")
    df.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# ------------------------------------------------------------------ FM-index
@pytest.mark.parametrize("symbols", [1, 2, 7, 300])
def test_wavelet_rank(symbols):
    r = np.random.default_rng(symbols)
    seq = np.concatenate([np.arange(symbols), r.zipf(1.4, 1500) % symbols])
    matrix = fm_index.WaveletMatrix(seq, symbols)
    c, ends = r.integers(0, symbols, 200), r.integers(0, len(seq) + 1, (2, 200))
    got = matrix.rank(c, ends)
    assert all(got[k, i] == np.count_nonzero(seq[:ends[k, i]] == c[i]) for k in range(2) for i in range(200))


@pytest.mark.parametrize("depth", [1, 4, 5, 20])
def test_matching_statistics(depth):
    r = np.random.default_rng(depth)
    seqs = [r.integers(1, 5, r.integers(1, 60)).astype(np.uint64) for _ in range(25)]
    seqs += [seqs[2], seqs[0][1:].copy() if len(seqs[0]) > 1 else seqs[3]]
    index = fm_index.FMIndex(seqs, depth)
    text = np.concatenate([np.concatenate([[0], s]) for s in seqs]).astype(int)
    asked = np.concatenate([[-1] * depth, index.symbols(np.concatenate([seqs[1], np.array([99], np.uint64), seqs[4]]))])
    words = np.concatenate([[0] * depth, seqs[1], [99], seqs[4]]).astype(int)
    ends = np.arange(depth + 1, len(asked) + 1)
    for least in (1, 2):
        matched, low, high = index.matching(asked, ends, least)
        for e, m, lo, hi in zip(ends, matched, low, high):
            def places(j):
                return [i for i in range(len(text) - j + 1) if (text[i:i + j] == words[e - j:e]).all()]
            held = [j for j in range(1, depth + 1) if min(words[e - j:e]) > 0 and len(places(j)) >= least]
            best = 0
            while best + 1 in held:
                best += 1
            assert m == best
            if best:
                assert hi - lo == len(places(best))
            if best == depth and len(places(depth)) > 1:
                assert index.first_place(np.array([lo]))[0] == min(places(depth))


# ------------------------------------------------------------------ 11
def plain_dedup(rows, window=20):
    """rows: (doc_id, text, text hash)."""
    words = [(t or "").encode().split() for _, t, _ in rows]
    first = {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][2])):
        for s in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][s:s + window]), (rows[i][0], rows[i][2], s))
    out = []
    for (doc_id, _, h), w in zip(rows, words):
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] != (doc_id, h, s):
                gone[s:s + window] = [True] * window
        out.append((str(doc_id), len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out)


@pytest.mark.parametrize("hot,shard,window", [(512, 1 << 18, 20), (2, 500, 20), (0, 200, 20), (512, 1 << 18, 3)])
def test_substring_dedup(docs, monkeypatch, hot, shard, window):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", shard)
    got = substring_dedup.dedup(docs, window)
    assert got.columns == docs.columns + ["n_removed"]
    rows = [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64("text")).collect()]
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.text) for r in got.collect()) == plain_dedup(rows, window)


def test_substring_dedup_of_a_repeating_text(spark):
    texts = ["a b " * 60, "x " * 500, "q " + "a b " * 12, None, "", "p q r " * 9 + " ".join(map(str, range(200)))]
    df = spark.createDataFrame([(9 - i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = [tuple(r) for r in df.select("doc_id", "text", F.xxhash64("text")).collect()]
    got = substring_dedup.dedup(df).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.text) for r in got) == plain_dedup(rows)


def test_intervals(docs, empty):
    removed = {(r.doc_id, r.text_hash): r.k for r in substring_dedup.intervals(docs).groupBy("doc_id", "text_hash").agg(
        F.sum("length").alias("k")).collect()}
    texts = docs.drop("text_hash").withColumn("h", F.xxhash64("text"))
    for r in substring_dedup.dedup(texts).collect():
        assert removed.get((r.doc_id, r.h), 0) == r.n_removed
    assert substring_dedup.dedup(empty).count() == substring_dedup.intervals(empty).count() == 0


# ------------------------------------------------------------------ 12
def plain_collocations(rows, minimum, best, longest=5):
    """rows: (lang, text)."""
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(ASCII)):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        known = {p: a for p, a in c.items() if len(p) > 1 and a >= minimum}
        inside = {p[i:i + k] for p, a in known.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
                  if 100 * a >= 100 * c[p[i:i + k]]}
        scored = []
        for p, a in known.items():
            if p not in inside:
                s, k = min((1000 * a * total[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, total[lang], -s)
                for i, (s, a, p, l, r) in enumerate(sorted(scored)[:best], 1)]
    return sorted(out)


@pytest.mark.parametrize("limit", [2_000_000, 10, 700])
def test_collocations(docs, monkeypatch, limit):
    """With tries, without them, and with a switch in between."""
    monkeypatch.setattr(phrase_mining, "BROADCAST_PHRASES", limit)
    monkeypatch.setattr(phrase_mining, "HELD", 50)
    monkeypatch.setattr(phrase_mining, "CHUNK", 3000)
    monkeypatch.setattr(phrase_mining, "BLOCK", 100)
    got = sorted(map(tuple, phrase_mining.collocations(docs, 3, best=60).collect()))
    want = plain_collocations([tuple(r) for r in docs.select("lang", "text").collect()], 3, 60)
    assert got == want and len(got) > 100


def test_longer_phrases_than_the_tries_hold_are_cut_to_frequent_parts(docs, monkeypatch):
    """Above the bound only phrases whose parts the tries hold are shuffled, not all of the texts."""
    rows = phrase_mining.chunks(docs)
    made, candidates = [], phrase_mining._candidates
    monkeypatch.setattr(phrase_mining, "_candidates", lambda r, tries, k, m: made.append(tries) or candidates(r, tries, k, m))
    want = sorted(map(tuple, phrase_mining.frequent(rows, 3)[0].collect()))
    by_size = Counter(x[1] for x in want)
    assert by_size[3] > 0
    shuffled, given = phrase_mining._shuffled, []
    monkeypatch.setattr(phrase_mining, "_shuffled", lambda *x: given.append(x[3:]) or shuffled(*x))
    monkeypatch.setattr(phrase_mining, "BROADCAST_PHRASES", by_size[1] + by_size[2])
    made.clear()
    assert sorted(map(tuple, phrase_mining.frequent(rows, 3)[0].collect())) == want
    assert [k for _, k in given] == [3] and max(t.depth.max() for t in given[0][0].values()) == 2


def test_tries_are_sent_without_what_tasks_do_not_read(spark):
    r = random.Random(5)
    few = phrase_mining.Trie.of([f"w{i}" for i in range(3000)])
    often = np.minimum(r.choices(range(1, 3001), weights=[1 / i for i in range(1, 3001)], k=60000), 3000)
    key = np.unique(np.stack([often[:-1], often[1:]], 1), axis=0)
    trie = few.grown(key[:, 0], key[:, 1])
    sent = trie.sent()
    assert {k for k, v in sent.items() if v is not None} == {"words", "base", "check"}
    assert sum(sent[k].nbytes for k in ("words", "base", "check")) < 100 * len(trie.parent)
    named = phrase_mining.Trie(**trie.sent(names=True))
    node = np.arange(len(trie.parent) - 50, len(trie.parent))
    assert named.phrases(node) == [f"w{a - 1} w{b - 1}" for a, b in zip(trie.parent[node], trie.code[node])]
    assert trie.parent.nbytes + trie.code.nbytes + trie.depth.nbytes == 9 * len(trie.parent)


def test_candidates_travel_packed(spark, monkeypatch):
    """No row per pair is shuffled: tasks send arrays, whose sums are those of all pairs."""
    monkeypatch.setattr(phrase_mining, "HELD", 50)  # pass sums on early, merge them often
    r = random.Random(9)
    texts = [(i, " ".join(r.choices("abcdefghij", k=60)), "en" if i % 3 else None) for i in range(120)]
    rows = phrase_mining.chunks(spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(5))
    tries = {lang: phrase_mining.Trie.of(list("abcdefghij")) for lang in ("en", "und")}
    found = phrase_mining._candidates(rows, tries, 2, 60)
    want = Counter((lang or "und", a, b) for _, t, lang in texts for a, b in zip(t.split(), t.split()[1:]))
    got = {(x.lang, "abcdefghij"[(x.key >> 32) - 1], "abcdefghij"[(x.key & 0xFFFFFFFF) - 1]): x.n for x in found.collect()}
    assert got == {k: n for k, n in want.items() if n >= 60} and len(want) > len(got) > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and "hashpartitioning(lang" in plan


def test_collocations_of_odd_texts(spark, empty):
    texts = ["A b. a b\ta  b\nA B!a b", None, "", " \t\n", "a b\x00 c é É a b", "x." * 50, "The the the the the the the"]
    df = spark.createDataFrame([(t, l) for t in texts for l in (None, "und", "en")], "text string, lang string")
    got = sorted(map(tuple, phrase_mining.collocations(df, 2).collect()))
    assert got == plain_collocations([(r.lang, r.text) for r in df.collect()], 2, 2000)
    assert phrase_mining.collocations(empty).count() == 0


def test_trie_holds_its_phrases_only():
    r = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    trie = phrase_mining.Trie.of(words)
    known = {(i,) for i in range(1, 41)}
    for depth in (1, 2, 3):
        level = [p for p in sorted(known) if len(p) == depth]
        more = sorted({r.choice(level) + (r.randrange(1, 41),) for _ in range(300)})
        node = {tuple(p): i for i, p in enumerate(_paths(trie))}
        trie = trie.grown(np.array([node[p[:-1]] for p in more]), np.array([p[-1] for p in more]))
        known |= set(more)
    assert sorted(p for p in _paths(trie) if p) == sorted(known)
    codes = np.array([r.randrange(0, 41) for _ in range(5000)], dtype=np.int32)
    for level, at, _ in phrase_mining.states(trie, codes, 4, len(codes)):
        assert at.tolist() == [i for i in range(len(codes) - level + 1) if tuple(codes[i:i + level].tolist()) in known]


def _paths(trie):
    out = [()]
    for p, c in zip(trie.parent[1:].tolist(), trie.code[1:].tolist()):
        out.append(out[p] + (c,))
    return out


# ------------------------------------------------------------------ 13
def plain_search(docs, items, top=10):
    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(ASCII))

    held = [(i, Counter(x), len(x)) for i, x in ((i, terms(t)) for i, t in docs) if x]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        asked, found = Counter(terms(text)), []
        for i, c, n in held:
            m = 25 + 75 * n * n_docs // n_terms
            s = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, k in asked.items() if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("bucket,block", [(4096, 2000), (16, 2000), (5, 7)])
def test_impact_search(spark, docs, empty, monkeypatch, bucket, block):
    monkeypatch.setattr(impact_search, "BUCKET", bucket)
    monkeypatch.setattr(impact_search, "BLOCK", block)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    asked = [(1, "abc Fg, hh ab ab"), (2, None), (3, ""), (None, "aa bb cc dd ee"), (4, "Spam spam"), (4, "spam"), (5, "zzzzzz")]
    asked += [(100 + i, t) for i, (_, t) in enumerate(rows[:30])]
    items = spark.createDataFrame(asked, "item_id long, text string")
    got = sorted(map(tuple, impact_search.search(docs, items).collect()), key=str)
    assert got == plain_search(rows, asked)
    assert impact_search.search(empty, items).count() == impact_search.search(docs, items.limit(0)).count() == 0


def test_impact_search_skips_buckets(spark, monkeypatch):
    """Late buckets of short vectors are left out, with the same result."""
    seen = []
    monkeypatch.setattr(impact_search, "BUCKET", 50)
    r = random.Random(2)
    rows = [(i, " ".join(r.choices("abcdefghij", k=3)) + (" rare term" * 3 if i % 90 == 0 else "")) for i in range(900)]
    items = [(0, "rare term"), (1, "rare a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = impact_search.search(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == plain_search(rows, items)
    # the same buckets, here
    numbers = {t: k for k, t in enumerate([b"rare", b"term", b"a"])}
    vectors = impact_search.vectors(docs, numbers)
    n_docs, n_terms, df = impact_search.statistics(vectors, 3)
    weight = impact_search.weights(n_docs, df)
    made = []
    for x in vectors.filter(F.size("terms") > 0).collect():
        m = 25 + 75 * x.n * n_docs // n_terms
        impacts = [10**9 * t // (1000 * t + 8 * m) for t in x.tf]
        made.append((math.sqrt(sum(float(weight[t]) * i * i for t, i in zip(x.terms, impacts))), x.doc_id, x.terms, impacts))
    made.sort(key=lambda x: -x[0])
    queries = impact_search.Queries([[0, 1]], weight)
    for k in range(0, len(made), 50):
        part = made[k:k + 50]
        b = pa.RecordBatch.from_arrays([pa.array([x[1] for x in part]), pa.array([x[0] for x in part]),
                                        pa.array([x[2] for x in part], pa.list_(pa.int32())),
                                        pa.array([x[3] for x in part], pa.list_(pa.int32()))], ["doc_id", "norm", "terms", "impacts"])
        seen.append(impact_search.Bucket(b, weight).search(queries, 0, np.zeros(3, dtype=np.int64)))
    assert seen[0] and not seen[-1]


# ------------------------------------------------------------------ whole tables
def test_against_plain_versions_on_a_table(spark):
    d = SF["0.001"]
    docs, items = table(spark, d, "documents"), table(spark, d, "benchmark")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted(map(tuple, impact_search.search(docs, items).collect()), key=str)
    assert got == plain_search(rows, [tuple(r) for r in items.select("item_id", "text").collect()])
