"""Quality rules: an isolation forest over rule statistics.

Every document gets rule statistics in one pass without a shuffle. A forest of
random splits is grown on a bounded sample of documents labelled good; junk
falls out of it after few splits. The anomaly score is the usual
``2 ** -(mean path length / c(sample))``. The threshold comes from all labelled
rows: their scores are counted per score bin in Spark, and the bin edge is taken
that keeps at least ``keep_good`` of the good rows and, beyond that, has the best
balanced accuracy.

Scale: the sample is bounded by ``sample_rows`` (documented parameter: the good
rows with the smallest seeded hash of their id), the bins by ``BINS``; the forest
is a few hundred KB and is sent to the tasks. Scoring is vectorized over chunks.

Defined cases: a null or empty text has no words, fails the base rules and is not
kept; labels with nulls, or of documents that are missing, are ignored; a
document labelled more than once is counted once per label; without good labels
there is no forest and only the base rules decide; repeated rows are judged each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StructField

from .words import Words, annotate, run_hashes, runs_within

REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SAMPLE_ROWS = 8192
TREES = 100
TREE_ROWS = 256
KEEP_GOOD = 0.995
BINS = 2000
SEED = 20


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOLS = _table(b"#*$%&|<>")
_MARKS = _table(b".,;:!?\"'()-")
_UPPER = _table(bytes(range(0x41, 0x5B)))
_LOWER = _table(bytes(range(0x61, 0x7B)))
_DIGITS = _table(bytes(range(0x30, 0x3A)))

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("symbols", "dup_lines", "repeats", "same_word", "upper", "marks", "bangs", "digits", "word_length")


def rule_statistics(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The counts of every text, and a matrix of the forest's features."""
    w = Words(texts)
    n = w.n_texts
    counts = w.counts
    points = (w.data & 0xC0) != 0x80
    word_chars = w.per_text(w.inside & points)
    n_symbols = w.per_text(_SYMBOLS[w.data])
    hashes = w.hashes()
    owner = w.text_of

    covered = np.zeros(len(hashes) + 1, np.int64)
    at = runs_within(w.bounds, REPEAT_WINDOW)
    if len(at):
        values = run_hashes(hashes, REPEAT_WINDOW)[at]
        texts_of = owner[at]
        order = np.lexsort((values, texts_of))
        v, t = values[order], texts_of[order]
        same = (v[1:] == v[:-1]) & (t[1:] == t[:-1])
        twice = np.zeros(len(v), bool)
        twice[1:] |= same
        twice[:-1] |= same
        first = at[order[twice]]
        np.add.at(covered, first, 1)
        np.add.at(covered, first + REPEAT_WINDOW, -1)
    repeated = np.concatenate(([0], np.cumsum(np.cumsum(covered[:-1]) > 0)))
    n_repeat = repeated[w.bounds[1:]] - repeated[w.bounds[:-1]]

    # words equal to the one before them, in the same text
    again = np.concatenate(([0], np.cumsum(np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1]))) if len(hashes) else np.zeros(0, bool))))
    n_again = again[w.bounds[1:]] - again[w.bounds[:-1]]

    n_dup, n_lines = np.zeros(n, np.int64), np.zeros(n, np.int64)
    raw = w.data.tobytes()
    for i, (s, e) in enumerate(zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist(), strict=True)):
        lines = [x for x in raw[s:e].split(b"\n") if x and not x.isspace()]
        n_lines[i], n_dup[i] = len(lines), len(lines) - len(set(lines))

    stats = dict(zip(COUNTS, (counts, word_chars, n_symbols, n_dup, n_repeat), strict=True))
    word, letter = np.maximum(counts, 1), np.maximum(word_chars, 1)
    upper, lower = w.per_text(_UPPER[w.data]), w.per_text(_LOWER[w.data])
    features = np.column_stack([
        n_symbols / letter,
        n_dup / np.maximum(n_lines, 1),
        n_repeat / word,
        n_again / word,
        upper / np.maximum(upper + lower, 1),
        w.per_text(_MARKS[w.data]) / word,
        w.per_text(w.data == 0x21) / word,
        w.per_text(_DIGITS[w.data]) / letter,
        word_chars / word,
    ])
    return stats, features


def base_failed(stats: dict[str, np.ndarray]) -> np.ndarray:
    n = stats["n_words"]
    return (n < MIN_WORDS) | (100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * n)


def _mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, float)
    big = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(big - 1) + np.euler_gamma) - 2 * (big - 1) / big, np.where(n == 2, 1.0, 0.0))


@dataclass
class IsolationForest:
    """Trees as arrays: per tree (feature, cut, left child, path length at a leaf).

    Cuts are drawn over the range of the tree's rows widened by ``margin`` of it
    on both sides, so values outside the sample can be cut off too.
    """

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    rows: int

    @classmethod
    def grow(cls, sample: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = SEED, margin: float = 0.5):
        rng = np.random.default_rng(seed)
        rows = min(rows, len(sample))
        limit = max(1, int(np.ceil(np.log2(max(rows, 2)))) + 2)
        span = np.ptp(sample, axis=0)
        floor = np.maximum(span, 1e-3) * 0.1
        grown = []
        for _ in range(trees):
            feature, cut, left, path = [], [], [], []
            picked = sample[rng.choice(len(sample), rows, replace=False)]
            todo = [(picked, 0)]
            slots = [0]
            feature.append(-1), cut.append(0.0), left.append(0), path.append(0.0)
            while todo:
                x, depth = todo.pop()
                at = slots.pop()
                if depth >= limit or len(x) <= 1:
                    path[at] = depth + float(_mean_path(len(x)))
                    continue
                f = int(rng.integers(x.shape[1]))
                low, high = x[:, f].min(), x[:, f].max()
                wide = margin * max(high - low, floor[f])
                c = float(rng.uniform(low - wide, high + wide))
                below = x[:, f] < c
                feature[at], cut[at], left[at] = f, c, len(feature)
                for part in (x[below], x[~below]):
                    slots.append(len(feature))
                    todo.append((part, depth + 1))
                    feature.append(-1), cut.append(0.0), left.append(0), path.append(0.0)
            grown.append((np.array(feature), np.array(cut), np.array(left), np.array(path)))
        return cls(grown, rows)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score of each row in (0, 1]; higher is odder."""
        total, every = np.zeros(len(x)), np.arange(len(x))
        for feature, cut, left, path in self.trees:
            at = np.zeros(len(x), int)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[every, np.maximum(f, 0)] >= cut[at]
                at = np.where(inner, left[at] + right, at)
            total += path[at]
        return 2.0 ** (-total / len(self.trees) / max(float(_mean_path(self.rows)), 1.0))


_STAT_FIELDS = [StructField(c, LongType()) for c in COUNTS]


def _statistics(text: str):
    def judge(part: pa.RecordBatch) -> dict[str, object]:
        stats, features = rule_statistics(part.column(part.schema.get_field_index(text)))
        return {**stats, "features": pa.array(list(features), pa.list_(pa.float64()))}

    return judge


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
    sample_rows: int = SAMPLE_ROWS, keep_good: float = KEEP_GOOD, seed: int = SEED,
) -> tuple[IsolationForest | None, float]:
    """Grow the forest on at most ``sample_rows`` good rows; calibrate on all labelled rows."""
    from .storage import store

    # only labelled documents are looked at here; labels are small beside texts
    wanted = labels.select(F.col(doc_id).alias("id"), F.col(quality).alias("q")).where("id is not null and q in (0, 1)")
    stats, name = annotate(
        docs.select(doc_id, text), text, "s", [*_STAT_FIELDS, StructField("features", ArrayType(DoubleType()))],
        _statistics(text), keep=[doc_id],
    )
    joined = stats.select(F.col(doc_id).alias("id"), F.col(f"{name}.features").alias("x"),
                          F.col(f"{name}.n_words").alias("n")).join(wanted, "id")
    rows = store(joined, "labelled")
    order = [F.xxhash64(F.lit(seed), "id"), "id"]
    sample = rows.where(f"q = 1 and n >= {MIN_WORDS}").orderBy(*order).limit(sample_rows).select("x").toArrow()
    if not sample.num_rows:
        return None, 1.0
    matrix = np.stack([np.asarray(v, float) for v in sample.column("x").to_pylist()])
    forest = IsolationForest.grow(matrix, seed=seed)
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def bins(batches):
        for b in batches:
            if b.num_rows:
                x = np.asarray(b.column("x").flatten()).reshape(b.num_rows, -1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("q"), pa.array(np.minimum((shared.value.score(x) * BINS).astype(int), BINS - 1))], ["q", "bin"])

    counted = (
        rows.where(f"n >= {MIN_WORDS}").select(F.col("q").cast("long").alias("q"), "x")
        .mapInArrow(bins, "q long, bin long").groupBy("q", "bin").count().collect()
    )
    good, bad = np.zeros(BINS), np.zeros(BINS)
    for r in counted:
        (good if r.q == 1 else bad)[r.bin] += r["count"]
    return forest, threshold_of(good, bad, keep_good)


def threshold_of(good: np.ndarray, bad: np.ndarray, keep_good: float) -> float:
    """Bin edge below which a score is kept."""
    kept = np.concatenate(([0], np.cumsum(good))) / max(good.sum(), 1)
    dropped = 1 - np.concatenate(([0], np.cumsum(bad))) / max(bad.sum(), 1)
    if not bad.sum():
        return float(np.argmax(kept >= keep_good)) / len(good)
    value = np.where(kept >= keep_good, kept + dropped, -1)
    best = np.flatnonzero(value >= value.max() - 1e-12)
    return float(best[-1]) / len(good)  # of equal edges the most lenient


def judge_quality(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
    keep: list[str] | None = None, **fitting,
) -> tuple[DataFrame, str]:
    """Append a struct: the rule counts, base_failed, score and kept.

    Returns the frame and the struct's name; ``keep`` names the columns kept.
    """
    forest, threshold = fit(docs, labels, doc_id, text, quality, **fitting)
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    fields = [*_STAT_FIELDS, StructField("base_failed", BooleanType()), StructField("score", DoubleType()),
              StructField("kept", BooleanType())]

    def judge(part: pa.RecordBatch) -> dict[str, object]:
        stats, features = rule_statistics(part.column(part.schema.get_field_index(text)))
        failed = base_failed(stats)
        score = np.zeros(len(failed)) if shared.value is None else shared.value.score(features)
        return {**stats, "base_failed": failed, "score": score, "kept": ~failed & ((score < threshold) | (shared.value is None))}

    frame = docs.select(*dict.fromkeys([*(docs.columns if keep is None else keep), text]))
    return annotate(frame, text, "rules", fields, judge, keep=keep)
