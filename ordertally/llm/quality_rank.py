"""Quality by Bradley-Terry pairwise ranking.

A document's score is linear in style features of its whole text.  The
weights are learned from preference pairs (a labelled good document against
a labelled bad one) by the logistic loss on the difference of their
features, as in the Bradley-Terry model.  The decision cuts the ranking at
the quantile of the scores of all training rows that the share of bad
documents gives, and a logistic link puts that cut at ``THRESHOLD``.

Features are computed in one pass over all documents and written as a narrow
table; training takes at most ``SAMPLE_ROWS`` labelled rows of it (in the
order of a hash of the id) and ``PAIRS`` pairs.

Defined cases: null and empty texts have the features of a text without
words and are scored like any other; rows without a label, or with a null
one, train nothing; of several labels of one document the largest counts;
repeated rows are scored each; without both classes among the training
labels every score is ``UNTRAINED_SCORE``.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertally.llm.common import bounded_broadcast, crc_of_id, fields, map_columns, staged, words_of

SAMPLE_ROWS = 40_000
CUT_ACCURACY = 20_000  # ranks of the cut are right to one part in this many
PAIRS = 200_000
RIDGE = 1e-3
SEED = 17
THRESHOLD = 0.3
UNTRAINED_SCORE = 0.9

FEATURES = (
    "log_words", "letters", "upper", "digits", "symbols", "stops", "commas", "bars", "other_marks", "non_ascii",
    "spaces", "line_ends", "mean_word", "long_words", "short_words", "distinct_words", "top_word", "repeated_pairs",
    "distinct_lines", "mean_line", "end_marks", "capital_words", "entropy",
)

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": b"0123456789",
    "symbols": b"#*$%&<>@^~=+_\\/",
    "stops": b".!?",
    "commas": b",;:",
    "bars": b"|",
    "other_marks": b"()[]{}\"'`-",
    "spaces": b" \t",
    "line_ends": b"\n\r",
}
_CLASS_AT = {name: np.frombuffer(chars, np.uint8) for name, chars in _CLASSES.items()}
_END = re.compile(r"[.!?][\"')\]]*\s*$")


def features(text: str | None) -> list[float]:
    """Style figures of a whole text, in the order of ``FEATURES``."""
    text = text or ""
    raw = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    total = max(1, int(raw.sum()))
    share = {name: raw[at].sum() / total for name, at in _CLASS_AT.items()}
    share["non_ascii"] = raw[128:].sum() / total
    share["letters"] = raw[97:123].sum() / total
    p = raw[raw > 0] / total
    words = words_of(text)
    n = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    pairs = set(zip(words, words[1:]))
    lines = [x for x in text.split("\n") if x.strip()]
    shown = text.split()
    return [
        float(np.log1p(len(words))), share["letters"], share["upper"], share["digits"], share["symbols"],
        share["stops"], share["commas"], share["bars"], share["other_marks"], share["non_ascii"], share["spaces"],
        share["line_ends"], float(sizes.mean()), float((sizes > 12).mean()), float((sizes < 3).mean()),
        len(counts) / n, max(counts.values(), default=0) / n, 1 - len(pairs) / max(1, len(words) - 1),
        len(set(lines)) / max(1, len(lines)), float(np.log1p(len(words) / max(1, len(lines)))),
        sum(bool(_END.search(x)) for x in lines) / max(1, len(lines)),
        sum(w[0].isupper() for w in shown) / max(1, len(shown)), float(-(p * np.log(p)).sum()),
    ]


def feature_table(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``features``, one double array per document."""
    return map_columns(
        docs, ["text"], fields("features array<double>"), lambda t: [[features(x) for x in t.to_pylist()]], keep
    )


def preference_pairs(y: np.ndarray, pairs: int = PAIRS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Places of a preferred and a rejected row for each of ``pairs`` pairs; every row takes part in turn."""
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    take = lambda a: np.concatenate([rng.permutation(a) for _ in range(-(-pairs // len(a)))])[:pairs]
    return take(good), take(bad)


def fit_pairs(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS) -> np.ndarray:
    """Bradley-Terry weights of (standardised) feature rows: logistic loss on differences, Newton's steps."""
    better, worse = preference_pairs(y, pairs)
    d = x[better] - x[worse]
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        g = d.T @ (1 - p) / len(d) - RIDGE * w
        h = (d * (p * (1 - p))[:, None]).T @ d / len(d) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w += step
        if np.abs(step).max() < 1e-7:
            break
    return w


def _curved(x: np.ndarray) -> np.ndarray:
    """Standardised features and their squares, both bounded."""
    z = np.clip(x, -8, 8)
    return np.hstack([z, np.minimum(z * z, 16)])


class RankModel:
    """Linear ranking scores, the cut at a quantile, and the link that puts the cut at ``THRESHOLD``."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        self.weights = fit_pairs(_curved((x - self.mean) / self.scale), y)
        s = self.rank(x)
        self.cut = float(np.quantile(s, (y == 0).mean()))
        self.slope = 4 / max(1e-6, float(np.median(s[y == 1]) - np.median(s[y == 0])))

    def rank(self, x: np.ndarray) -> np.ndarray:
        return _curved((x - self.mean) / self.scale) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        s = self.rank(x)
        return 1 / (1 + np.exp(-np.clip(self.slope * (s - self.cut), -30, 30) - np.log(THRESHOLD / (1 - THRESHOLD))))


def train(table: DataFrame, labels: DataFrame) -> RankModel | None:
    """Fit on labelled rows of a feature table (doc_id, features) whose crc32(doc_id) mod 5 is not 0."""
    use = (F.pmod(crc_of_id(), F.lit(5)) != 0) & F.col("doc_id").isNotNull()
    known = (
        labels.select("doc_id", F.col("quality").cast("int").alias("label"))
        .filter(F.col("label").isNotNull() & use)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    rows = table.filter(use).join(bounded_broadcast(known), "doc_id").withColumn("__at", F.xxhash64("doc_id"))
    n = rows.count()
    # Hashes are even, so the sample lies below this one: no partition sends more than its part of it.
    share = 1.1 * SAMPLE_ROWS / max(n, 1)
    low = rows if share >= 1 else rows.filter(F.col("__at") < int(-(2**63) + share * 2**64))
    sample = low.orderBy("__at", "doc_id", "features").limit(SAMPLE_ROWS).select("features", "label").toPandas()
    y = (sample["label"] > 0).to_numpy(int)
    if not 0 < y.sum() < len(y):
        return None
    model = RankModel(np.stack(sample["features"].to_numpy()), y)
    if n > len(sample):
        _cut_over_all(model, rows)
    return model


def _cut_over_all(model: RankModel, rows: DataFrame) -> None:
    """Take the cut, and the scale of the link, from all training rows: two aggregates."""

    def run(features):
        return [model.rank(np.asarray(features.flatten(), float).reshape(len(features), len(FEATURES)))]

    ranked = map_columns(rows, ["features"], fields("rank double"), run, ["label"])
    bad = F.col("label") <= 0
    part = ranked.agg(F.avg(bad.cast("double"))).first()[0]
    quantile = lambda p, which: F.percentile_approx(F.when(which, F.col("rank")), F.lit(p), F.lit(CUT_ACCURACY))
    cut, lower, upper = ranked.agg(quantile(part, F.lit(True)), quantile(0.5, bad), quantile(0.5, ~bad)).first()
    model.cut, model.slope = cut, 4 / max(1e-6, upper - lower)


def score_quality(table: DataFrame, model: RankModel | None, keep: list[str]) -> DataFrame:
    """``score`` (0 to 1) and ``predicted`` (1 if the score reaches ``THRESHOLD``) for rows of a feature table."""

    def run(column):
        if model is None:
            s = np.full(len(column), UNTRAINED_SCORE)
        else:
            s = model.scores(np.asarray(column.flatten(), float).reshape(len(column), len(FEATURES)))
        return [s, (s >= THRESHOLD).astype(np.int32)]

    return map_columns(table, ["features"], fields("score double, predicted int"), run, keep)


def op9(docs: DataFrame, labels: DataFrame) -> DataFrame:
    table = staged(docs.sparkSession, feature_table(docs, ["doc_id"]), "style-features")
    scored = score_quality(table, train(table, labels), ["doc_id"])
    return scored.select("doc_id", (F.pmod(crc_of_id(), F.lit(5)) == 0).alias("held_out"), "score", "predicted")
