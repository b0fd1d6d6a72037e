"""Quality classifier: positive-unlabelled learning.

Trusted positives are labelled rows; every document of the corpus is
unlabelled.  The class prior is estimated first: a positives-against-corpus
classifier ranks both, and the smallest ratio between the corpus's and the
positives' share above a threshold (best-bin estimate with its confidence
terms) bounds the share of positives.  Then an additive model of text
statistics minimises the non-negative unbiased risk with the logistic loss,

    prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)]),

whose first terms join to ``E_u[softplus(g)] - prior * E_p[g]``, a convex
function.  Newton steps need one pass over the corpus's statistics each; a step
is halved while it raises the risk or makes the bracket (the negatives' risk)
negative, so the descent ends where the correction would set in.

Scale: texts are read once into 14 numbers a document; a pass adds up a
gradient and an 85 x 85 matrix per task, and tasks' sums are added in a second
stage before a fixed 16 reach the driver.  All documents and all labels are
used; nothing is sampled.  Labels, language, source and ids never enter a
score.

Defined cases: null or empty text has the statistics of zero words and gets a
score like any other; rows without an id can't be trusted positives and are
held in training as unlabelled text; repeated rows count as often as they
occur; an id labelled both 0 and 1 isn't trusted.  Without a trusted positive every score
is 0.5.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import TEXTS, cut, fold, ship

ship(__name__)

FOLDS, HELD_OUT = 3, 1
#: Range over which each statistic is spread on KNOTS hat functions; outside it is clipped.
RANGES = {
    "log_words": (0.0, 10.0), "log_word_bytes": (0.5, 3.0), "upper": (-6.2, 0.0), "digits": (-6.2, 0.0),
    "symbols": (-6.2, 0.0), "shouts": (-6.2, 0.0), "stops": (-6.2, 0.0), "other_marks": (-6.2, 0.0),
    "high_bytes": (-6.2, 0.0), "kinds": (-5.0, 0.0), "pair_kinds": (-5.0, 0.0), "same_lines": (-4.6, 0.0),
    "top_word": (-5.0, 0.0), "words_a_line": (0.0, 8.0),
}
KNOTS = 6
WIDTH = 1 + KNOTS * len(RANGES)
#: Ridge penalty times the number of trusted positives.
RIDGE = 2.5
PRIOR_STEPS, RISK_STEPS, BINS = 5, 10, 200
PRIOR_LIMITS = (0.01, 0.99)

_LOW = np.array([a for a, _ in RANGES.values()], dtype=np.float32)
_HIGH = np.array([b for _, b in RANGES.values()], dtype=np.float32)
_SETS = [list(range(65, 91)), list(range(48, 58)), list(b"#*$%&|<>"), list(b"!?"), list(b".,;:"),
         [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "#*$%&|<>!?.,;:"], list(range(128, 256))]
_BLANK = [9, 10, 11, 12, 13, 32]


def statistics(text: bytes) -> list[float]:
    """The numbers of RANGES, in order, of one whole text."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return [float(x) for x in _LOW]
    seen = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    solid = int(seen.sum() - seen[_BLANK].sum())
    shares = [float(np.log(0.002 + seen[s].sum() / solid)) for s in _SETS]
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    return [float(np.log(n)), float(np.log(solid / n)), *shares, float(np.log(len(counts) / n)),
            float(np.log(max(pairs, 1) / max(n - 1, 1))),
            float(np.log(0.01 + 1 - len(set(lines)) / len(lines))),
            float(np.log(max(counts.values()) / n)), float(np.log(n / len(lines)))]


def spread(x: np.ndarray) -> np.ndarray:
    """Statistics (rows x 14) to model inputs (rows x WIDTH): a constant and hat functions."""
    at = (np.clip(x, _LOW, _HIGH) - _LOW) / (_HIGH - _LOW) * (KNOTS - 1)
    hats = np.clip(1 - np.abs(at[:, :, None] - np.arange(KNOTS)), 0, 1)
    return np.hstack([np.ones((len(x), 1)), hats.reshape(len(x), -1)])


def _softplus(g: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, g)


def _sigmoid(g: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * g))


def _stack(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float32).reshape(-1, len(RANGES))


def statistics_table(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and statistics of every row, written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            x = np.array([statistics(t or b"") for t in texts], dtype=np.float32).reshape(len(texts), -1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"),
                                              pa.array([r.tobytes() for r in x], pa.binary())],
                                             ["doc_id", "held_out", "x"])

    rows = docs.select("doc_id", "text", (fold(F.col("doc_id"), FOLDS, 0) == HELD_OUT).alias("held_out"))
    kind = dict(rows.dtypes)["doc_id"]
    return cut(rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, x binary"), "quality-numbers", TEXTS)


def trusted_positives(numbers: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of the rows whose id is labelled 1 in the training folds.  The
    prior's ranker learns from ``half`` = 0 and its estimate reads ``half`` = 1; the risk has all."""
    ids = (labels.filter(fold(F.col("doc_id"), FOLDS, HELD_OUT) != HELD_OUT)
           .groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
           .filter("low = 1 and high = 1").select("doc_id"))
    return cut(numbers.join(ids, "doc_id").select("x", F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("half")),
               "trusted")


def _pass(numbers: DataFrame, w: np.ndarray) -> dict[str, np.ndarray]:
    """Count, sum of softplus(g), sum of softplus(-g), sum of inputs, gradient
    and curvature sums of softplus(g) over all rows, and a histogram of sigmoid(g)."""
    size = 3 + 2 * WIDTH + WIDTH * WIDTH + BINS

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            x = _stack(b.column("x"))
            for k in range(0, len(x), 4096):
                f = spread(x[k:k + 4096])
                g = f @ w
                s = _sigmoid(g)
                total += np.concatenate([
                    [len(f), _softplus(g).sum(), _softplus(-g).sum()], f.sum(0), s @ f,
                    ((f * (s * (1 - s))[:, None]).T @ f).ravel(),
                    np.bincount(np.minimum((s * BINS).astype(int), BINS - 1), minlength=BINS)])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            for v in b.column("sums").to_pylist():
                total += np.frombuffer(v)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    parts = numbers.select("x").mapInArrow(add, "sums binary").repartition(16).mapInArrow(join, "sums binary")
    total = sum((np.frombuffer(r.sums) for r in parts.collect()), np.zeros(size))
    at = np.cumsum([3, WIDTH, WIDTH, WIDTH * WIDTH])
    return {"n": total[0], "plus": total[1], "minus": total[2], "inputs": total[3:at[1]],
            "gradient": total[at[1]:at[2]], "curve": total[at[2]:at[3]].reshape(WIDTH, WIDTH), "bins": total[at[3]:]}


def estimate_prior(numbers: DataFrame, positives: DataFrame) -> float:
    """Share of positives in the corpus, by the best bin of a positives-against-corpus classifier.

    The bin is read from positives that the classifier hasn't learnt from,
    unless one of the halves is empty; then both steps have all.
    """
    learnt, unseen = positives.filter("half = 0"), positives.filter("half = 1")
    if learnt.isEmpty() or unseen.isEmpty():
        learnt = unseen = positives
    w = np.zeros(WIDTH)
    for _ in range(PRIOR_STEPS):
        u, p = _pass(numbers, w), _pass(learnt, w)
        ridge = RIDGE / p["n"]
        slope = u["gradient"] / u["n"] + (p["gradient"] - p["inputs"]) / p["n"] + ridge * w
        w = w - np.linalg.solve(u["curve"] / u["n"] + p["curve"] / p["n"] + ridge * np.eye(WIDTH), slope)
    u, p = _pass(numbers, w), _pass(unseen, w)
    above_u, above_p = np.cumsum(u["bins"][::-1]) / u["n"], np.cumsum(p["bins"][::-1]) / p["n"]
    slack = np.sqrt(np.log(40) / (2 * u["n"])) + np.sqrt(np.log(40) / (2 * p["n"]))
    some = above_p > 0
    # The bound rather than the bare ratio: with few positives the ratio falls short and clean documents would go.
    bound = (above_u[some] + 1.01 * slack) / above_p[some]
    return float(np.clip(bound.min(), *PRIOR_LIMITS))


def minimise_risk(numbers: DataFrame, positives: DataFrame, prior: float) -> np.ndarray:
    """Weights of the smallest non-negative unbiased risk found."""
    def at(w: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
        u, p = _pass(numbers, w), _pass(positives, w)
        mean, ridge = p["inputs"] / p["n"], RIDGE / p["n"]
        negative = u["plus"] / u["n"] - prior * p["plus"] / p["n"]
        risk = u["plus"] / u["n"] - prior * (mean @ w) + ridge / 2 * (w @ w)
        slope = u["gradient"] / u["n"] - prior * mean + ridge * w
        return risk, negative, slope, u["curve"] / u["n"] + ridge * np.eye(WIDTH)

    w = np.zeros(WIDTH)
    risk, _, slope, curve = at(w)
    step = 1.0
    for _ in range(RISK_STEPS):
        new = w - step * np.linalg.solve(curve, slope)
        found = at(new)
        if found[1] < 0 or found[0] > risk:
            step /= 2
            continue
        gain = risk - found[0]
        w, (risk, _, slope, curve), step = new, found, min(1.0, 2 * step)
        if gain < 1e-5:
            break
    return w


def fit(numbers: DataFrame, labels: DataFrame) -> np.ndarray:
    """Weights learnt from the trusted positives and the whole corpus; zeros without positives."""
    positives = trusted_positives(numbers, labels)
    if positives.isEmpty():
        return np.zeros(WIDTH)
    return minimise_risk(numbers, positives, estimate_prior(numbers, positives))


def score_column(text: Column, w: np.ndarray) -> Column:
    """Score of a text column."""
    def run(texts: pd.Series) -> pd.Series:
        x = np.array([statistics((t or "").encode()) for t in texts], dtype=np.float32).reshape(len(texts), -1)
        return pd.Series(_sigmoid(spread(x) @ w))

    return F.pandas_udf(run, "double")(text)


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    numbers = statistics_table(docs)
    w = fit(numbers, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = _sigmoid(spread(_stack(b.column("x"))) @ w)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    kind = dict(numbers.dtypes)["doc_id"]
    return numbers.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows predicted 1, with all their columns."""
    w = fit(statistics_table(docs), labels)
    rows = docs.select(F.struct("*").alias("_row"), score_column(F.col("text"), w).alias("_score"))
    return rows.filter("_score >= 0.5").select("_row.*")
