"""Operators against brute-force versions on small frames: nulls, empty and long texts, ties, repeated
rows, empty tables and columns with clashing names."""
import hashlib
import math
import random
import re
import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

from ripplelake.llm import (components, fingerprints, lm_scoring, mixing, ngram_join, packing, quality_classifier,
                            quality_rules, token_counts, url_filters, warc)
from ripplelake.llm.common import running_sum
from ripplelake.session import scratch_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sample(seed=1, n=120):
    """Random texts with copies, near copies, shared passages, nulls and repeats."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdefgh", k=r.randint(2, 6))) for _ in range(400)]
    passage = " ".join(r.choices(vocabulary, k=60))
    rows = []
    for i in range(n):
        words = r.choices(vocabulary, k=r.randint(12, 160))
        if i % 5 == 1:
            words = rows[-1][1].split(" ") if rows[-1][1] else words
            if i % 10 == 1:
                words = list(words)
                words[r.randrange(len(words))] = "Changed."
        text = " ".join(words)
        if i % 7 == 3:
            text = text + "\n" + passage + ". Tail " + str(i)
        rows.append([i, text, r.choice(["en", "fr", None]), r.choice(["b", "b", "b", "a", "c", None]), 0])
    rows[4][1], rows[5][1], rows[6][1], rows[8][1] = None, "", " \n\t", "Two words"
    rows[9][1] = " ".join(r.choices(vocabulary, k=9000))
    rows[10][1] = rows[9][1] + " more"
    rows[12][1] = "spam *** " * 30
    return [tuple(x) for x in rows] + [tuple(rows[20])] + [(None, rows[21][1], None, None, None)]


@pytest.fixture(scope="module")
def rows():
    return sample()


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With extra columns named like the operators' own."""
    df = spark.createDataFrame(rows, DOCS).withColumns(
        {c: F.lit(i) for i, c in enumerate(["kept", "n_words", "_words", "score", "size", "node", "_text", "pivot"])})
    path = scratch_path(spark, "sample")
    df.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words_of(text):
    return (text or "").encode().split()


# ------------------------------------------------------------------ 9
def test_rules_base_statistics(docs, rows, empty):
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                 for r in quality_rules.rate(docs).collect())
    want = []
    for i, t, *_ in rows:
        w = words_of(t)
        t = t or ""
        windows = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        hit = {k + j for k in range(len(w) - 4) if windows[tuple(w[k:k + 5])] > 1 for j in range(5)}
        lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\f\r")]
        want.append((str(i), len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t),
                     len(lines) - len(set(lines)), len(hit), len(w) < 10 or 100 * len(hit) > 20 * len(w)))
    assert got == sorted(want)
    assert quality_rules.rate(empty).count() == 0 and quality_rules.keep(empty).count() == 0


def test_rules_reject_outliers_and_keep_columns(spark):
    r = random.Random(3)
    vocabulary = ["".join(r.choices("abcdefghij", k=r.randint(3, 7))) for _ in range(500)]
    data = []
    for i in range(300):
        w = r.choices(vocabulary, k=100)
        if i % 10 == 0:
            w = [x + "***" for x in w]
        data.append((i, " ".join(w), "en" if i % 2 else None, "s" if i < 280 else "rare", 0))
    df = spark.createDataFrame(data, DOCS).withColumn("distance", F.lit("x"))
    out = quality_rules.keep(df)
    assert out.columns == df.columns
    # the 20 rows of small groups are too few for an estimate even together
    assert sorted(x.doc_id for x in out.collect()) == [i for i in range(300) if i % 10 or i >= 280]


def test_whitening_matches_numpy(spark):
    r = np.random.default_rng(5)
    a = r.normal(size=(5, 5))
    cov = a @ a.T
    x, m = r.normal(size=5), r.normal(size=5)
    row = {f"c{i}{j}_s": float(cov[i, j]) for i in range(5) for j in range(i + 1)} | {
        f"m{i}_s": float(m[i]) for i in range(5)} | dict(zip(quality_rules.Z, map(float, x)))
    df = quality_rules._whitened(spark.createDataFrame([row]), "s")
    got = df.select(quality_rules._squares("s").alias("d"), "det_s").first()
    full = quality_rules.CONSISTENCY * cov + np.diag([f ** 2 for f in quality_rules.FLOOR.values()])
    assert got.d == pytest.approx((x - m) @ np.linalg.solve(full, x - m))
    assert got.det_s == pytest.approx(np.linalg.slogdet(full)[1])


def test_starts_are_rows_of_narrow_frames(spark, monkeypatch):
    """The driver plans one start's columns, and the estimates of all three are rows."""
    seen, cut = {}, quality_rules.cut

    def seen_cut(df, name):
        out = seen[name] = cut(df, name)
        return out

    monkeypatch.setattr(quality_rules, "cut", seen_cut)
    r = np.random.default_rng(6)
    data = [(i, " ".join(f"w{x}" for x in r.integers(0, 400, 60)), "en", "s" if i % 2 else None, 0) for i in range(200)]
    best = quality_rules.fit(quality_rules.statistics_table(spark.createDataFrame(data, DOCS))).collect()
    estimates = seen["mcd-estimates"]
    assert len(estimates.columns) <= 30 and len(seen["mcd-limits"].columns) == 3
    assert estimates.groupBy("group").count().filter("count = 3").count() == 2
    least = {x.d for x in estimates.groupBy("group").agg(F.min("det_best").alias("d")).collect()}
    chosen = {(x.det_best, x.m0_best, x.w40_best) for x in estimates.collect() if x.det_best in least}
    assert len(best) == 2 and {(x.m0_best, x.w40_best) for x in best} <= {c[1:] for c in chosen}


# ------------------------------------------------------------------ 7
def test_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF['0.01']}/{t}.parquet") for t in ("documents", "labels"))
    out = quality_classifier.rate(docs, labels)
    pairs = out.join(labels, "doc_id").filter("held_out").select("predicted", "quality", "score").collect()
    assert sum(p.predicted == p.quality for p in pairs) / len(pairs) > 0.97
    assert all(0 <= r.score <= 1 for r in out.select("score").collect())
    held = {r.doc_id: r.held_out for r in out.collect()}
    assert held == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in held}


def test_prior_is_read_from_unseen_positives(spark):
    """The ranker learns from one half; a kind of text that only the other half
    holds is not ranked first, so the bound takes in all that is above it."""
    low, high = quality_classifier._LOW, quality_classifier._HIGH
    a, b, c = (x.astype(np.float32).tobytes() for x in (low, high, low + (high - low) * 0.4))
    numbers = spark.createDataFrame([(a,)] * 500 + [(b,)] * 100 + [(c,)] * 400, "x binary")
    positives = spark.createDataFrame([(a, 0)] * 200 + [(b, 1)] * 200, "x binary, half long")
    assert quality_classifier.estimate_prior(numbers, positives) > 0.6
    for half in (0, 1):
        alone = spark.createDataFrame([(b, half)] * 200, "x binary, half long")
        assert quality_classifier.estimate_prior(numbers, alone) < 0.3


def test_classifier_edges(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    out = quality_classifier.rate(docs, labels)
    assert out.count() == docs.count() and out.filter("score is null").count() == 0
    assert {r.score for r in quality_classifier.rate(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_classifier.rate(empty, labels).count() == 0
    assert quality_classifier.keep(docs, labels.limit(0)).columns == docs.columns


# ------------------------------------------------------------------ 5
def brute_components(rows):
    sets = []
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    part = list(range(len(rows)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                part[find(a)] = find(b)
    ids = defaultdict(list)
    for k, r in enumerate(rows):
        ids[find(k)].append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted((str(r[0]), len(sets[k]), str(least[find(k)] if sets[k] else r[0])) for k, r in enumerate(rows))


def got_components(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.components(df).collect())


def test_join_is_exact(docs, rows, empty):
    assert got_components(docs) == brute_components(rows)
    assert ngram_join.components(empty).count() == 0


@pytest.mark.parametrize("block", [4096, 7])
def test_join_of_a_large_near_copy_group(spark, monkeypatch, block):
    """Copies at about the threshold: many regions, chains across pivots, blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "PIVOTS", (2, 3, None))
    r = random.Random(11)
    base = [f"w{r.randrange(10**6)}" for _ in range(70)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(w), "en", "s", 0))
    df = spark.createDataFrame(rows, DOCS)
    assert got_components(df) == brute_components(rows)


def half_length_pair():
    """Near copies of a long text, one component after a round, and two near
    copies of its first half, which meet only in the regions of all of them."""
    r = random.Random(5)
    base = [f"w{r.randrange(10**6)}" for _ in range(300)]
    rows = [(i, " ".join([*base, f"x{i}"]), "en", "s", 0) for i in range(60)]
    first, last = base[:150], base[:150]
    first[50], last[100] = "y1", "y2"
    return rows + [(60, " ".join(first), "en", "s", 0), (61, " ".join(last), "en", "s", 0)]


def test_join_goes_on_after_a_round_without_open_pairs(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PIVOTS", (2, 3, None))
    rows = half_length_pair()
    df = spark.createDataFrame(rows, DOCS)
    got = got_components(df)
    assert got == brute_components(rows)
    assert {c for i, _, c in got if i in ("60", "61")} == {"60"}


def test_links_within_components(spark, monkeypatch):
    """Every pair of near copies is measured, also when both are in one component."""
    monkeypatch.setattr(ngram_join, "PIVOTS", (2, 3, None))
    r = random.Random(12)
    base = [f"w{r.randrange(10**6)}" for _ in range(70)]
    rows = []
    for i in range(24):
        w = list(base)
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(w), "en", "s", 0))
    rows += [(30, rows[3][1], "en", "s", 0), (31, "", "en", "s", 0)]
    sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in (t.split() for _, t, *_ in rows)]
    classes = {}
    for (i, *_), x in zip(rows, sets):
        classes.setdefault(frozenset(x), i)
    want = {(a, b) for x, a in classes.items() for y, b in classes.items()
            if a < b and x and y and 100 * len(x & y) >= 75 * len(x | y)}
    df = spark.createDataFrame(rows, DOCS)
    got = ngram_join.links(df).collect()
    assert len(got) == len(want) and {tuple(sorted((x.a_id, x.b_id))) for x in got} == want
    counts = Counter(i for pair in want for i in pair)
    assert {x.doc_id: (x.class_id, x.n_links) for x in ngram_join.link_counts(df).collect()} == {
        i: (i if not x else classes[frozenset(x)], counts[classes[frozenset(x)]]) for (i, *_), x in zip(rows, sets)}


def test_keep_one(docs, rows):
    out = ngram_join.keep_one(docs)
    parts = dict((i, c) for i, _, c in brute_components(rows))
    kept = [r.doc_id for r in out.collect()]
    assert out.columns == docs.columns
    assert sorted(map(str, kept)) == sorted([i for i, c in parts.items() if i == c] + ["None"])


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_rows_looked_for_go_through_no_broadcast_join(docs, rows, monkeypatch, most):
    """The driver holds 8 bytes a row of what is looked for, no table of it; above the bound nothing."""
    sent, hashes = [], []
    monkeypatch.setattr(F, "broadcast", lambda df, f=F.broadcast: sent.append(df.columns) or f(df))
    among = ngram_join._among
    monkeypatch.setattr(ngram_join, "_among", lambda df: hashes.append(df.count()) or among(df))
    monkeypatch.setattr(ngram_join, "BROADCAST_NODES", most)
    want = dict((i, c) for i, _, c in brute_components(rows))
    kept = ngram_join.keep_one(docs).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted([i for i, c in want.items() if i == c] + ["None"])
    assert not [c for c in sent if {"_hash", "text_hash"} & {*c}]
    assert len(hashes) >= 2 and min(hashes) > 0 if most else not hashes


def test_among_passes_all_rows_looked_for(spark):
    df = spark.createDataFrame([(i if i % 7 else None, i % 50) for i in range(300)], "doc_id long, text_hash long")
    some = df.filter("text_hash < 20")
    test = ngram_join._among(some)("doc_id", "text_hash")
    assert df.filter(test).count() == some.count() == 120
    assert df.filter(ngram_join._among(some.limit(0))("doc_id", "text_hash")).count() == 0


def test_keep_one_keeps_a_row_of_each_component(spark):
    """Ids that repeat with unlike texts, equal rows, and copies without an id."""
    r = random.Random(3)
    texts = [" ".join(f"w{r.randrange(10**6)}" for _ in range(60)) for _ in range(6)]
    a, b, c, d, e, f = texts
    rows = [(3, b, 1), (7, a, 2), (7, b + " more", 3), (8, c, 4), (8, d, 5), (9, e, 6), (9, e, 7),
            (None, f, 8), (None, f, 9), (None, f + " more", 10), (10, "", 11), (10, " ", 12), (11, "", 13)]
    df = spark.createDataFrame([(i, t, "en", "s", n) for i, t, n in rows], DOCS)
    got = [(x.doc_id, x.n_chars) for x in ngram_join.keep_one(df).collect()]
    one_of = [{(3, 1)}, {(7, 2)}, {(8, 4)}, {(8, 5)}, {(9, 6), (9, 7)}, {(None, 8), (None, 9), (None, 10)},
              {(10, 11), (10, 12)}, {(11, 13)}]
    assert len(got) == len(one_of)
    assert all(len(x & set(got)) == 1 for x in one_of)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.component for r in components.connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)}


# ------------------------------------------------------------------ 10
def test_running_sum_with_a_hot_group(spark):
    df = spark.range(500).select((F.col("id") % 7 == 0).cast("int").alias("g"), "id", (F.col("id") % 5).alias("v"))
    got = {r.id: r.s for r in running_sum(df, ["g"], ["id"], "v", "s").collect()}
    sums, want = defaultdict(int), {}
    for i in range(500):
        want[i] = sums[i % 7 == 0]
        sums[i % 7 == 0] += i % 5
    assert got == want


def test_mix_targets_and_uses(docs, rows, empty):
    out = mixing.taken_words(docs).collect()
    sizes = defaultdict(int)
    for _, t, _, s, _ in rows:
        sizes[s] += len(words_of(t))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, pot, target = set(names), 1.5 * sum(sizes.values()), {}
    while left:
        share = {s: pot * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] > 2 * sizes[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2 * sizes[s]
            pot -= target[s]
            left.discard(s)
    taken = defaultdict(int)
    for r in out:
        assert r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 2 * mixing.BLOCK_WORDS for s in names)
    assert sorted(map(str, mixing.taken_words(docs).collect())) == sorted(map(str, out))
    assert mixing.taken_words(empty).count() == 0


def test_mixed_documents_hold_the_taken_words(docs):
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[(r.doc_id, r.source)] += len(words_of(r.text))
        assert r.n_chars == len(r.text)
    taken = Counter()
    for r in mixing.taken_words(docs).collect():
        taken[(r.doc_id, r.source)] += r.taken
    assert +words == +taken


def test_permutation():
    for n in (1, 2, 3, 64, 65, 1000):
        p = mixing.permute(np.arange(n), n, np.full(n, 99, dtype=np.uint64))
        assert sorted(p) == list(range(n))


# ------------------------------------------------------------------ 6
def test_packing(docs, rows, empty):
    model = packing.tokenizer_model()
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_str(model)
    want = Counter()
    for i, t, *_ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            part = ids[k:k + 4096]
            want[(i, k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    packed = packing.pack(docs, model, with_ids=True)
    out = packed.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    places = defaultdict(list)
    for r in out:
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in out)
    assert len(places) <= math.ceil(total / 4096) + 1
    assert sum(len(r.ids) // 4 for r in packing.sequences(packed).collect()) == total
    assert packing.pack(empty, model).count() == 0


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer
    model = packing.tokenizer_model()
    r = random.Random(9)
    letters = "abzABZ019'sStTdD.,!?-_<>|*\u00e9\u00c9\u00df\u00d1\u00a0\u0085\u00aa\u00b2\u00bd\u0130\u01c5\x1c\u0301\u03a3\u4e2d\U0001f600"
    texts = ["".join(r.choices(letters + "  \n\t", k=r.randint(0, 40))) for _ in range(4000)]
    texts += ["<|endoftext|> a<|startoftext|>b", "''s don't WE'LL I'M x'RE '", "e\u0301 E\u0301"]
    whole = Tokenizer.from_str(model).encode_batch(texts, add_special_tokens=False)
    got = packing.Encoder(model)(pa.array(texts))
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [e.ids + [1] for e in whole]
    assert list(packing.Encoder(model)(pa.array([None, ""]))) == [b"\x01\0\0\0"] * 2
    assert list(packing.Encoder(model)(pa.array([], pa.string()))) == []


def test_plan_is_best_fit_decreasing():
    r = random.Random(2)
    lengths = [r.randint(1, 100) for _ in range(3000)] + [100] * 50 + [1] * 200
    rows = packing.plan_slots(dict(Counter(lengths)), 100)
    bins = defaultdict(list)
    for length, low, high, first, each, offset in rows:
        for k in range(high - low):
            bins[first + k // each].append((offset + k % each * length, length))
    assert sum(map(len, bins.values())) == len(lengths)
    free = []
    for length in sorted(lengths, reverse=True):  # item by item
        fits = [x for x in free if x >= length]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - length)
        else:
            free.append(100 - length)
    assert len(bins) == len(free)
    assert sorted(100 - sum(n for _, n in b) for b in bins.values()) == sorted(free)


def test_planned_join_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = packing.plan_slots({5: 7, 3: 9}, 12)
    ranked = spark.createDataFrame([(n, k) for n, c in ((5, 7), (3, 9)) for k in range(c)], "length long, rank long")
    a = sorted(map(tuple, packing.take_slots(ranked, rows).collect()))
    monkeypatch.setattr(packing, "BROADCAST_PLAN", 0)
    assert sorted(map(tuple, packing.take_slots(ranked, rows).collect())) == a


# ------------------------------------------------------------------ 8
def brute_base(rows):
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t, *_ in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in tokens]
    counts = Counter(w for (_, ws), h in zip(tokens, held) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    return sorted((str(i), h, len(ws), sum(counts[w] > 0 for w in ws), n,
                   round(sum(math.log10((counts[w] + .1) / (n + .1 * (v + 1))) for w in ws), 6))
                  for (i, ws), h in zip(tokens, held))


def test_scores(docs, rows, empty, monkeypatch):
    model = lm_scoring.train(docs)
    out = lm_scoring.score(docs, model).collect()
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out)
    assert got == brute_base(rows)
    assert all(r.score <= 0 for r in out)
    monkeypatch.setattr(lm_scoring, "BROADCAST_MB", (model.filter_mb + model.words_mb) / 3)
    assert len(lm_scoring._groups(model)) > 1
    assert sorted(map(str, lm_scoring.score(docs, model).collect())) == sorted(map(str, out))
    assert lm_scoring.score(empty, lm_scoring.train(empty)).count() == 0


@pytest.mark.parametrize("share", [0.2, 1.5])
def test_scores_in_passes_write_texts_once(docs, monkeypatch, share):
    """Chunks of word numbers are written once for each pass over words, of which there is one or more; passes over pairs add
    sums only."""
    model = lm_scoring.train(docs)
    want = sorted(map(str, lm_scoring.score(docs, model).collect()))
    wrote, cut = [], lm_scoring.cut
    monkeypatch.setattr(lm_scoring, "cut", lambda df, name, *x: wrote.append((name, df.columns)) or cut(df, name, *x))
    monkeypatch.setattr(lm_scoring, "BROADCAST_MB", share * model.words_mb)
    monkeypatch.setattr(lm_scoring, "CHUNK_TOKENS", 2000)
    monkeypatch.setattr(lm_scoring, "BLOCK", 300)
    assert sorted(map(str, lm_scoring.score(docs, model).collect())) == want
    assert not [name for name, columns in wrote if "text" in columns]
    chunks = [name for name, columns in wrote if "tokens" in columns]
    assert len(chunks) == (5 if share < 1 else 1) and len(wrote) == len(chunks) + len(lm_scoring._groups(model)) + 1 > 3


def test_packed_numbers():
    for x in (np.array([], np.uint32), np.array([5, 2**32 - 1, 0], np.uint32)):
        assert lm_scoring._unpacked(lm_scoring._packed(x), len(x), "u4").tolist() == x.tolist()
    x = np.sort(np.random.default_rng(1).integers(0, 2**63, 999).astype(np.uint64))
    assert (lm_scoring._numbers(lm_scoring._planes(x), "u8") == x).all()
    v = np.log10(np.random.default_rng(2).random(5000))
    high, low = lm_scoring._fixed(v)
    assert abs(high.sum() / lm_scoring.HIGH + low.sum() / lm_scoring.LOW - math.fsum(v)) < 1e-9


def test_score_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF['0.01']}/documents.parquet")
    r = lm_scoring.score(docs, lm_scoring.train(docs)).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_filter_levels_never_fall_short(docs):
    model = lm_scoring.train(docs)
    part = lm_scoring.Part(lm_scoring._collected(model, None), model.segments)
    levels = part.levels(part.words)
    assert (levels >= lm_scoring.levels_of(part.counts)).all()
    assert (levels == lm_scoring.levels_of(part.counts)).mean() > 0.9


def test_word_probabilities_sum_to_one(docs):
    model = lm_scoring.train(docs)
    part = lm_scoring.Part(lm_scoring._collected(model, None), model.segments)
    exact, levels = part.word_levels(np.append(part.words, np.uint64(12345)))  # the last is unknown
    assert (levels[:-1] == lm_scoring.levels_of(part.counts)).all() and levels[-1] == exact[-1] == 0
    held = lm_scoring.COUNT_OF_LEVEL[levels] + lm_scoring.ADD
    assert held.sum() / (model.mass + lm_scoring.ADD * (model.distinct + 1)) == pytest.approx(1, abs=1e-12)


def brute_determinant(x):
    """Minimum-covariance-determinant centre and scatter (with the floor) in numpy."""
    q = quality_rules
    floor = np.array(list(q.FLOOR.values()))

    def quantile(v, share):
        return np.sort(v)[math.ceil(share * len(v)) - 1]

    def estimate(d):
        near = x[d <= quantile(d, q.KEEP)]
        return near.mean(axis=0), q.CONSISTENCY * np.cov(near.T, bias=True) + np.diag(floor ** 2)

    def squares(m, c):
        return ((x - m) @ np.linalg.inv(c) * (x - m)).sum(axis=1)

    middle = np.array([quantile(c, 0.5) for c in x.T])
    scale = np.maximum([1.4826 * quantile(abs(c - m), 0.5) for c, m in zip(x.T, middle)], floor)
    unit = abs(x - middle) / scale
    ends = []
    for start in ((unit ** 2).sum(axis=1), unit.max(axis=1), unit.sum(axis=1)):
        m, c = estimate(start)
        for _ in range(q.STEPS):
            m, c = estimate(squares(m, c))
        ends.append((np.linalg.slogdet(c)[1], m, c))
    return min(ends, key=lambda e: e[0])[1:]


def test_verdicts_against_brute_force(spark):
    """Distances and verdicts of a whole table by numpy, with the groups that are pooled."""
    q = quality_rules
    stats = q.statistics_table(spark.read.parquet(f"{SF['0.01']}/documents.parquet"))
    rows = stats.collect()
    sound = Counter((r.lang, r.source) for r in rows if not r.base_failed)
    every = {(r.lang, r.source) for r in rows}
    by_lang = Counter()
    for g in every:
        by_lang[g[0]] += sound[g] if sound[g] < q.MIN_GROUP else 0
    rest = sum(n for n in by_lang.values() if n < q.MIN_GROUP)

    def pool(g):
        if sound[g] >= q.MIN_GROUP:
            return g
        return ("lang", g[0]) if by_lang[g[0]] >= q.MIN_GROUP else "rest" if rest >= q.MIN_GROUP else None

    members = defaultdict(list)
    for r in rows:
        if not r.base_failed:
            members[pool((r.lang, r.source))].append([r[z] for z in q.Z])
    found = {g: brute_determinant(np.array(x)) for g, x in members.items() if g is not None}
    want = {}
    for r in rows:
        g, distance = pool((r.lang, r.source)), None
        if g is not None and r[q.Z[0]] is not None:
            away = np.array([r[z] for z in q.Z]) - found[g][0]
            distance = float(away @ np.linalg.inv(found[g][1]) @ away)
        want[r.doc_id] = (distance, not r.base_failed and (distance is None or distance <= q.CUTOFF))
    got = q.judge(stats, q.fit(stats)).collect()
    assert len(got) == len(rows) == len(want)
    for r in got:
        distance, kept = want[r.doc_id]
        assert r.distance == (None if distance is None else pytest.approx(distance, rel=1e-6, abs=1e-6))
        assert r.kept == kept
    assert 0 < sum(not k for _, k in want.values()) < len(want) / 2 and len(found) > 1


def test_score_against_brute_force(docs, rows):
    """Scores from counts in dictionaries; the filter may only read a pair's level too high."""
    def tokens(text):
        return [w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")] + [None]

    texts = [(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0, tokens(r[1])) for r in rows]
    words, contexts, pairs = Counter(), Counter(), Counter()
    for held_out, t in texts:
        if not held_out:
            words.update(t)
            contexts.update(["<start>", *t[:-1]])
            pairs.update(zip(["<start>", *t[:-1]], t))

    def shown(n):
        if not n:
            return 0.0
        fits = [c for c in range(1, 3 * n + 3) if lm_scoring.levels_of(np.array([c]))[0] == lm_scoring.levels_of(np.array([n]))[0]]
        return (fits[0] + fits[-1]) / 2

    value = {n: shown(n) for n in {0, *words.values(), *contexts.values(), *pairs.values()}}
    mass = sum(value[n] for n in words.values()) + 0.1 * (len(words) + 1)

    def want(t):
        total = 0.0
        for h, w in zip(["<start>", *t[:-1]], t):
            c, of = value[words[w]], value[contexts[h]]
            both = min(value[pairs[h, w]], c, of)
            total += math.log10((both + lm_scoring.MU * min(1, (c + 0.1) / mass)) / (of + lm_scoring.MU))
        return total

    expected = defaultdict(list)
    for r, (_, t) in zip(rows, texts):
        expected[r[0]].append((want(t), len(t)))
    above = n = 0
    for r in lm_scoring.score(docs, lm_scoring.train(docs)).collect():
        value_, size = next((v, k) for v, k in expected[r.doc_id] if k == r.n_tokens)
        assert r.score >= value_ - 0.1 - 1e-9 * size  # the start context's level may be read one higher
        above, n = above + r.score - value_, n + size
    assert abs(above / n) < 0.02


# ------------------------------------------------------------------ 2
PARAGRAPH = re.compile(r"[^\n]{80,}?[.!?](?= |\n|$)|[^\n]+")


def test_fingerprints(spark, rows, empty):
    rows = [r for r in rows if r[0] is not None]
    out = defaultdict(set)
    for r in fingerprints.compare(spark.createDataFrame(rows, DOCS)).collect():
        out[r.doc_id].add(tuple(r))
    texts = dict((r[0], r[1] or "") for r in rows)
    order = sorted(texts)
    prints = {}

    def alike(a, b):
        a, b = set(PARAGRAPH.findall(a)), set(PARAGRAPH.findall(b))
        return len(a & b) / len(a | b) if a | b else 1.0

    for k, i in enumerate(order):
        t, after = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        (got,) = out[i]
        assert got[1:3] == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert got[5:] == pytest.approx((alike(t, edited), alike(t, after)))
        assert prints.setdefault(t, got[3]) == got[3]
        if edited == t:
            assert got[4] == got[3]
    assert fingerprints.compare(empty).count() == 0
    alone = fingerprints.compare(spark.createDataFrame([(3, "one line", None, None, 0)], DOCS)).first()
    assert alone.near_next == 1.0


def test_differences_recover_digests_and_retry(spark):
    r = random.Random(4)
    pairs, want = [], {}
    for p in range(40):
        both = [r.getrandbits(62) for _ in range(r.randint(0, 300))]
        left, right = ([r.getrandbits(62) for _ in range(r.choice([0, 1, 3, 200]))] for _ in range(2))
        pairs.append((p, both + left, right + both))
        want |= {(p, d): 1 for d in left} | {(p, d): -1 for d in right}
    df = spark.createDataFrame(pairs, "pair long, left array<long>, right array<long>")
    assert {(x.pair, x.digest): x.sign for x in fingerprints.differences(df).collect()} == want


# ------------------------------------------------------------------ 3
def test_cascade_is_exact():
    r = np.random.default_rng(8)
    keys = r.integers(0, 2 ** 63, size=(20000, 2)).astype(np.uint64)
    for n in (0, 1, 50, 15000, 20000):
        levels = url_filters.cascade_of(keys[:n], keys[n:])
        assert (url_filters.listed_by(levels, keys) == (np.arange(len(keys)) < n)).all()


def test_url_verdicts(spark, monkeypatch):
    urls = [None, "", "no scheme", "http://A.Example.COM/en/x?q#f", "http://www.example.com/en/", "http://x.net/es/1",
            "https://net/fr/", "http://net/fr", "http://example.com", "ftp://notexample.com/en/y", "http://b.org/en/",
            "http://b.org?x", "http://sub.www.example.com/en/é", "http://b.org/en/"]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    want = [("", "", None), ("", "", None), ("", "", None), ("a.example.com", "/en/x", "example.com/en/"),
            ("www.example.com", "/en/", "www.example.com/en/"), ("x.net", "/es/1", "net/es/"), ("net", "/fr/", "net/fr/"),
            ("net", "/fr", None), ("example.com", "", None), ("notexample.com", "/en/y", "com/"), ("b.org", "/en/", None),
            ("b.org", "", None), ("sub.www.example.com", "/en/é", "www.example.com/en/"), ("b.org", "/en/", None)]
    block = {"example.com/en/", "net/es/", "net/fr/"}
    want = [(i, h, p, x, "block" if x in block else "allow") for i, (h, p, x) in enumerate(want)]
    assert sorted(map(tuple, url_filters.judge(df).collect())) == want
    monkeypatch.setattr(url_filters, "BROADCAST_MB", 1e-5)
    assert sorted(map(tuple, url_filters.judge(df).collect())) == want
    assert url_filters.judge(df.limit(0)).count() == 0


# ------------------------------------------------------------------ 1
def test_commits_are_idempotent(spark):
    store = token_counts.create(spark, scratch_path(spark, "store"))

    def feed(*rows):
        return spark.createDataFrame(rows, "op string, source string, lang string, version string, tokens long, old_tokens long")

    def totals():
        return {tuple(r)[:3]: tuple(r)[3:] for r in token_counts.totals(spark, store).collect()}

    one = feed(("insert", "a", None, "v", 10, None), ("insert", "a", None, "v", 5, None), ("insert", None, "en", "v", None, None))
    assert totals() == {}
    assert token_counts.commit(one, store, "1") and not token_counts.commit(one, store, "1")
    assert totals() == {("a", None, "v"): (2, 15), (None, "en", "v"): (1, 0)}
    token_counts._write(token_counts.signed(one), store, "1", [])  # a second attempt that got through
    assert totals() == {("a", None, "v"): (2, 15), (None, "en", "v"): (1, 0)}
    token_counts.commit(feed(("delete", None, "en", "v", 0, None), ("revise", "a", None, "v", 7, 10)), store, "2")
    want = {("a", None, "v"): (2, 12)}
    assert totals() == want
    for _ in range(2):
        token_counts.compact(spark, store)
        assert totals() == want
    assert not token_counts.commit(one, store, "1")
    token_counts.commit(feed(), store, "3")
    assert totals() == want


# ------------------------------------------------------------------ 4
def test_warc_files_read_back(spark):
    html = ('<html lang="fr"><head><title>A\n b</title><style>p{}</style></head><body><!-- no --><p>Un &amp; deux</p>'
            '<script>var t="</p>";</script><a href="/x">lien</a><br/>fin &lt;é&gt;</body></html>')
    pages = spark.createDataFrame([(1, "http://a/b", html, "z"), (2, None, None, "z"), (1, "http://a/b", html, "z")],
                                  "page_id long, url string, html string, content string")
    records = warc.derivatives(warc.responses(pages), ["page_id"])
    text = [r.content for r in records.filter("page_id = 1 and warc_type = 'conversion'").collect()]
    assert text == ["A b\nUn & deux\nlien\nfin <é>"] * 2
    assert records.filter("page_id = 2").filter("warc_type = 'conversion'").first().content_length == 0
    path = scratch_path(spark, "warc")
    warc.write(records, path)
    raw = b"".join(r[0] for r in spark.read.format("binaryFile").load(path).select("content").collect())
    seen = []
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        n = int(fields[b"Content-Length"])
        block, end, raw = rest[:n], rest[n:n + 4], rest[n + 4:]
        assert end == b"\r\n\r\n"
        assert fields[b"WARC-Block-Digest"].decode() == "sha256:" + hashlib.sha256(block).hexdigest()
        seen.append((fields[b"WARC-Type"], fields[b"WARC-Refers-To"], block))
        uuid.UUID(fields[b"WARC-Record-ID"].decode()[10:-1])
    assert len(seen) == 6
    meta = next(b for t, _, b in seen if t == b"metadata" and b"/x" in b).decode()
    assert f"source-payload-digest: sha256:{hashlib.sha256(html.encode()).hexdigest()}" in meta
    assert "outlink: /x" in meta and "language: fr" in meta and "source-header: HTTP/1.1 200 OK" in meta
    assert warc.derivatives(warc.responses(pages.limit(0)), ["page_id"]).count() == 0


def test_compaction_beside_a_commit(spark, monkeypatch):
    """A batch that commits while a compaction runs counts once."""
    store = token_counts.create(spark, scratch_path(spark, "race"))

    def feed(tokens):
        return spark.createDataFrame([("insert", "a", "en", "v", tokens, None)],
                                     "op string, source string, lang string, version string, tokens long, old_tokens long")

    def total():
        return [(r.n_docs, r.n_tokens) for r in token_counts.totals(spark, store).collect()]

    token_counts.commit(feed(10), store, "1")
    kept = token_counts.cut
    for number, name in enumerate(("commits", "compacted"), 2):  # after the reading, and after the sums
        def beside(df, at, *rest, name=name, number=number):
            out = kept(df, at, *rest)
            if at == name:
                token_counts.commit(feed(5), store, str(number))
            return out

        with monkeypatch.context() as m:
            m.setattr(token_counts, "cut", beside)
            token_counts.compact(spark, store)
        assert total() == [(number, 5 + 5 * number)]
    token_counts.compact(spark, store)
    assert total() == [(3, 20)]
    plan = token_counts.totals(spark, store)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [attempt" in plan or "PartitionFilters: [isnotnull(attempt" in plan
