"""Toxicity by class-conditional Kneser-Ney models.

Texts are sequences of lower-cased word bytes; a symbol's history is what
stands before it in its word, at most five bytes, word start included.  Each
class (toxic, ordinary) has interpolated probabilities on its own counts of
documents.  Both back off to one Kneser-Ney model of all counts, continuation
counts below it, so an expression that is rare in both weighs nothing.  A
document's figure is the difference of its log-likelihoods under the two
classes divided by its length, over all its symbols: seen n-grams by their two
probabilities, symbols never seen after a history by what the two classes
leave to the shared model there; bytes that no training text has are left out.  The part of that difference which comes from
n-grams that speak clearly for a class is a second figure; a logistic curve of
both, fitted on labelled documents that the counts leave out, gives the score.

The counts cover four training rows in five, not yet the fifth of the curve.  Probabilities are DataFrame
aggregates and joins.  Scoring needs only the difference of the two log
probabilities per history and symbol.  The table of these is exact: sorted keys
and their ratios, broadcast for up to ``BROADCAST_ROWS`` n-grams (32 MB), beyond that
kept in sorted blocks in the shared folder.  A task then sums a text's words, and looks
up the n-grams of the distinct words of about ``GROUP_BYTES`` of texts in one pass over the
blocks; no text or n-gram of it is shuffled.  Both ways give the same sums, as
ratios are rounded to multiples of 2^-18, whose sums are exact.

Defined cases: null and empty texts, and texts without words, have
difference 0; unlabelled rows and rows with null labels train nothing; of
several labels of one document the largest counts; without both classes
among the training labels every score is ``UNTRAINED_SCORE``.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertally.llm.blocks import rows_at, sorted_blocks
from ordertally.llm.common import (
    BROADCAST_ROWS,
    PIECE_ROWS,
    col,
    crc_of_id,
    fields,
    groups,
    map_arrow,
    map_columns,
    pieces,
    staged,
    words_of,
)

ORDER = 6  # symbols of an n-gram, its history included; at most 8, to be packed into a long
DISCOUNT = 0.75
# An n-gram speaks clearly for a class where its share of toxic documents departs
# from that of its history by so many squared standard errors, as a multiple of
# the logarithm of the number of n-grams tried.
EVIDENCE = 2.2
SHARED_WEIGHT = 4.0  # occurrences that the shared model counts for in each class
BUCKETS = 1 << 23  # of a table without keys
RATIO_STEPS = 1 << 18  # ratios are multiples of one over this: exact as floats, and so are sums of them as doubles
CHUNK = 1 << 18  # bytes of text handled at once
GROUP_BYTES = 16 << 20  # of rows for which the blocks of a table are read once
GROUP_WORDS = 250_000  # distinct words after which they are read again
LABEL_GROUP_BYTES = 4 << 20  # of rows whose labels are looked up at once
THRESHOLD = 0.3
UNTRAINED_SCORE = 0.1
# One training row in so many is left out of the counts for the curve, and
# the curve is fitted on at most so many of them.
CALIBRATION_SHARE = 5
CALIBRATION_ROWS = 20_000
# Texts without any evidence that count as ordinary when the curve is fitted,
# so that a handful of rows cannot make a text toxic for nothing.
NEUTRAL_ROWS = 20


def _bytes(text: str | None) -> bytes:
    words = words_of(text.lower()) if text else []
    return b" " + b" ".join(words) + b" " if words else b""


def ngram_keys(data: bytes, start: int, end: int) -> np.ndarray:
    """The n-gram ending at each place of data[start:end]: its bytes packed, symbol lowest, history above."""
    lo = max(0, start - ORDER + 1)
    a = np.frombuffer(data, np.uint8, end - lo, lo)
    key, open_ = a.astype(np.uint64), np.ones(len(a), bool)
    for j in range(1, ORDER):
        prev = np.zeros_like(a)
        prev[j:] = a[:-j]
        prev[~open_] = 0
        key |= prev.astype(np.uint64) << np.uint64(8 * j)
        open_ &= (prev != 32) & (prev != 0)
    return key[start - lo :]


def bucket_of(keys: np.ndarray) -> np.ndarray:
    bits = BUCKETS.bit_length() - 1
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _joined(texts: list) -> tuple[bytes, np.ndarray]:
    """The bytes of all texts one after the other, and where each one ends."""
    parts = [_bytes(t) for t in texts]
    return b"".join(parts), np.cumsum([len(p) for p in parts], dtype=np.int64)


def _chunks(data: bytes, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(start, keys, whether the place counts): a text's leading space does not."""
    counts = np.ones(len(data), bool)
    counts[np.concatenate(([0], ends))[:-1][np.diff(np.concatenate(([0], ends))) > 0]] = False
    for s in range(0, len(data), CHUNK):
        e = min(len(data), s + CHUNK)
        yield s, ngram_keys(data, s, e), counts[s:e]


def _documents_with(data: bytes, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(n-grams, in how many texts each stands), part by part; a part holds whole texts unless one is longer."""
    for s, keys, use in _chunks(data, ends):
        of = np.searchsorted(ends, np.arange(s, s + len(keys)), side="right")[use]
        keys = keys[use].view(np.int64)
        order = np.lexsort((of, keys))
        keys, of = keys[order], of[order]
        first = np.ones(len(keys), bool)
        first[1:] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
        yield np.unique(keys[first], return_counts=True)


def ngram_counts(labelled: DataFrame, label_of: Callable[[pa.Array], pa.Array] | None = None) -> DataFrame:
    """(key, toxic, ordinary): documents with the n-gram, over all rows of ``labelled`` (text, label).

    With ``label_of`` the rows are (text, doc_id), and those whose id has a label count.
    """

    def with_labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in groups(batches, LABEL_GROUP_BYTES):
            labels = label_of(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), labels], ["text", "label"]).filter(labels.is_valid())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(with_labels(batches) if label_of else batches):
            label = np.array(b.column(1).to_pylist(), bool)
            texts = b.column(0).to_pylist()
            for kind in (True, False):
                data, ends = _joined([t for t, y in zip(texts, label, strict=True) if y == kind])
                for keys, n in _documents_with(data, ends):
                    zero = np.zeros(len(n), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys), *map(pa.array, (n, zero) if kind else (zero, n))], ["key", "toxic", "ordinary"]
                    )

    rows = map_arrow(labelled.select("text", "doc_id" if label_of else "label"), run, "key long, toxic long, ordinary long")
    return rows.groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _size(key: str = "key") -> Column:
    """Bytes of a packed n-gram."""
    out = F.lit(1)
    for n in range(2, ORDER + 1):
        out = F.when(F.shiftrightunsigned(key, 8 * (n - 1)) > 0, n).otherwise(out)
    return out


def _history() -> Column:
    return F.shiftrightunsigned("key", 8)


def _suffixes(longest: Column) -> Column:
    """The n-gram's last bytes: its ``longest``, ..., 2, 1 last ones."""
    masks = F.array(*[F.lit((1 << 8 * n) - 1 if n < 8 else -1) for n in range(ORDER, 0, -1)])
    return F.transform(F.slice(masks, ORDER + 1 - longest, longest), lambda m: F.col("key").bitwiseAND(m))


def shared_probabilities(counts: DataFrame) -> DataFrame:
    """(key, q): Kneser-Ney probability of each n-gram's symbol after the history without its oldest byte.

    Continuation counts (in how many n-grams one byte longer a suffix stands)
    are those of both classes together.  q adds up, from the shortest suffix
    to the longest, what each order keeps and what it leaves to the order below.
    """
    every = counts.select(F.explode(_suffixes(_size())).alias("key")).distinct()
    shorter = every.select(F.get(_suffixes(_size()), F.lit(1)).alias("key")).filter("key IS NOT NULL")
    followed = shorter.groupBy("key").agg(F.count("*").alias("cc"))
    followed = followed.withColumn("h", _history())
    sums = followed.groupBy("h").agg(F.sum("cc").alias("s"), F.count("*").alias("types"))
    # A history is followed by at most 256 symbols, so no group of the join is large.
    orders = followed.join(sums, "h").select(
        F.col("key").alias("suffix"),
        (F.greatest(F.col("cc") - DISCOUNT, F.lit(0.0)) / F.col("s")).alias("kept"),
        (DISCOUNT * F.col("types") / F.col("s")).alias("left"),
    )
    chains = counts.select("key", F.explode(F.slice(_suffixes(_size()), 2, ORDER)).alias("suffix"))
    parts = chains.join(orders, "suffix").groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct(_size("suffix").alias("n"), "kept", "left"))).alias("parts")
    )
    return parts.select(
        "key", F.aggregate("parts", F.lit(1 / 256), lambda q, x: x["kept"] + x["left"] * q).alias("q")
    )


def evidence_needed(ngrams: int) -> float:
    return EVIDENCE * float(np.log(max(2, ngrams)))


def _history_sums(counts: DataFrame) -> DataFrame:
    """(h, toxic_s, ordinary_s, toxic_types, ordinary_types, types) of each history."""
    return counts.groupBy(_history().alias("h")).agg(
        *[F.sum(c).alias(f"{c}_s") for c in ("toxic", "ordinary")],
        *[F.sum((F.col(c) > 0).cast("long")).alias(f"{c}_types") for c in ("toxic", "ordinary")],
        F.count("*").alias("types"),
    )


def _left(c: str) -> Column:
    """Occurrences after a history that a class leaves to the shared model."""
    return DISCOUNT * F.col(f"{c}_types") + SHARED_WEIGHT


def log_ratios(counts: DataFrame, ngrams: int | None = None) -> DataFrame:
    """(key, n, ratio, surprise): log of the toxic over the ordinary probability of every n-gram.

    With ``ngrams``, the number of rows of ``counts``, only the n-grams that
    speak clearly for a class.
    """
    rows = counts.withColumn("h", _history()).join(_history_sums(counts), "h").join(shared_probabilities(counts), "key")

    seen = F.col("toxic") + F.col("ordinary")
    pooled = (F.greatest(seen - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("types") * F.col("q")) / (
        F.col("toxic_s") + F.col("ordinary_s")
    )
    rows = rows.withColumn("pooled", pooled)

    def p(c: str):
        own = F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) + _left(c) * F.col("pooled")
        return own / (F.col(f"{c}_s") + SHARED_WEIGHT)

    share = F.col("toxic_s") / (F.col("toxic_s") + F.col("ordinary_s"))
    surprise = F.pow(F.col("toxic") - seen * share, 2) / (seen * share * (1 - share) + 1)
    rows = rows.select("key", seen.alias("n"), F.log(p("toxic") / p("ordinary")).alias("ratio"), surprise.alias("surprise"))
    return rows if ngrams is None else rows.filter(F.col("surprise") >= evidence_needed(ngrams))


def backoff_ratios(counts: DataFrame) -> DataFrame:
    """(key, ratio): the log ratio of a symbol never seen after a history.

    Both classes give such a symbol the shared probability times what they
    leave to the shared model, so the former cancels out.  The key is the
    history with symbol 0, which no text has.  After a history that the counts
    lack, both use the shared model alone, and the ratio is 0.
    """

    def mass(c: str):
        return _left(c) / (F.col(f"{c}_s") + SHARED_WEIGHT)

    return _history_sums(counts).select(
        F.shiftleft("h", 8).alias("key"), F.log(mass("toxic") / mass("ordinary")).alias("ratio")
    )


def ratio_table(counts: DataFrame, ngrams: int) -> DataFrame:
    """(key, ratio, clear): all log ratios; ``clear`` is the ratio of an n-gram that speaks clearly for a class, else 0."""
    seen = log_ratios(counts)
    clear = F.when(F.col("surprise") >= evidence_needed(ngrams), F.col("ratio")).otherwise(0.0)
    rows = seen.select("key", "ratio", clear.alias("clear")).unionByName(
        backoff_ratios(counts).withColumn("clear", F.lit(0.0))
    )
    return rows.select(
        "key", *[(F.rint(F.col(c) * RATIO_STEPS) / RATIO_STEPS).cast("float").alias(c) for c in ("ratio", "clear")]
    )


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic curve on standardised columns, by Newton's steps."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * len(x) * np.eye(len(w)) * (np.arange(len(w)) < len(w) - 1) + 1e-6 * np.eye(len(w))
        g = z.T @ (y - p) - ridge * len(x) * np.append(w[:-1], 0)
        step = np.linalg.solve(h, g)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1] / scale, float(w[-1] - (w[:-1] * mean / scale).sum())


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic curve that falls in no column: one that would gets weight 0."""
    used = list(range(x.shape[1]))
    while True:
        w, intercept = fit_logistic(x[:, used], y)
        if not used or w.min() >= 0:
            break
        del used[int(w.argmin())]
    weights = np.zeros(x.shape[1])
    weights[used] = w
    return weights, intercept


def with_none(keys: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(ratios, keys) with a last row, that of no n-gram."""
    ratios = np.append(np.column_stack(columns), np.zeros((1, len(columns)), np.float32), axis=0)
    return ratios, np.append(keys, np.iinfo(np.int64).max)


def _row_of(keys: np.ndarray, known: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Row of each n-gram among the sorted ``known``: its own, else its history's if the symbol is known, else the last."""
    keys = keys.view(np.int64)
    at = np.searchsorted(known, keys)
    new = np.flatnonzero(known[at] != keys)
    after = keys[new] & ~np.int64(255)
    at[new] = np.searchsorted(known, after)
    none = (known[at[new]] != after) | ~symbols[keys[new] & 255]
    at[new[none]] = len(known) - 1
    return at


def _sums(data: bytes, ends: np.ndarray, ratios: np.ndarray, row_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The ratios of each text's n-grams added up."""
    sums = np.zeros((len(ends) + 1, ratios.shape[1]))
    for s, keys, use in _chunks(data, ends):
        value = np.where(use[:, None], ratios[row_of(keys)], 0).astype(np.float64)
        # Places are dealt to their texts: each text's share of this chunk.
        total = np.concatenate((np.zeros((1, value.shape[1])), np.cumsum(value, axis=0)))
        edge = np.clip(ends, s, s + len(value)) - s
        sums[1:] += total[edge]
    return np.diff(sums, axis=0)


@dataclass
class ToxicityModel:
    # Broadcast arrays: the ratios, one row per key (their ``clear`` part as a second
    # column), and the sorted keys.  Without keys, ratios of BUCKETS hashed places.
    ratios: object = None
    weight: float = 0.0
    intercept: float = 0.0
    keys: object = None
    symbols: np.ndarray | None = None  # of each byte, whether the counts have it
    clear_weight: float = 0.0
    table: list[str] | None = None  # in place of the arrays: files with the table's sorted blocks

    @property
    def untrained(self) -> bool:
        return self.ratios is None and self.table is None

    def _at(self, keys: np.ndarray) -> np.ndarray:
        """Row of each n-gram: its own, else its history's if the symbol is known, else the last, which is 0."""
        if self.keys is None:
            return bucket_of(keys)
        return _row_of(keys, self.keys.value, self.symbols)

    def differences(self, texts: list) -> np.ndarray:
        """Length-normalised log-likelihood difference of each text: a row per text, a column per column of the ratios."""
        data, ends = _joined(texts)
        sums = _sums(data, ends, self.ratios.value.reshape(len(self.ratios.value), -1), self._at)
        sizes = np.diff(np.concatenate(([0], ends)))
        return sums / np.maximum(sizes - 1, 1)[:, None]

    def _of_words(self, words: list[bytes]) -> np.ndarray:
        """The sums of each word by the table's blocks."""
        parts = [b" " + w + b" " for w in words]
        data, ends = b"".join(parts), np.cumsum([len(p) for p in parts], dtype=np.int64)
        found = [np.unique(k[use].view(np.int64)) for _, k, use in _chunks(data, ends)]
        wanted = np.unique(np.concatenate([*found, *(k & ~np.int64(255) for k in found)]))
        keys, *ratios = rows_at(self.table, wanted)
        ratios, known = with_none(keys, ratios)
        return _sums(data, ends, ratios, lambda k: _row_of(k, known, self.symbols))

    def differences_by_words(self, texts: pa.Array) -> np.ndarray:
        """``differences`` by the table's blocks: what a symbol adds depends on its word alone."""
        out = np.zeros((len(texts), 2))
        numbers, of = defaultdict(itertools.count().__next__), []
        for at in range(0, len(texts), PIECE_ROWS):
            for text in texts.slice(at, PIECE_ROWS).to_pylist():
                words = words_of(text.lower()) if text else []
                of.append((np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)), sum(map(len, words)) + len(words)))
            last = at + PIECE_ROWS >= len(texts)
            if numbers and (last or len(numbers) >= GROUP_WORDS):
                sums = self._of_words(list(numbers))
                end = min(at + PIECE_ROWS, len(texts))
                for row, (words, size) in enumerate(of, end - len(of)):
                    out[row] = sums[words].sum(axis=0) / max(size, 1)
                numbers, of = defaultdict(itertools.count().__next__), []
        return out

    def difference(self, texts: list) -> np.ndarray:
        return self.differences(texts)[:, 0]

    def score(self, difference: Column, clear: Column) -> Column:
        if self.untrained:
            return F.lit(UNTRAINED_SCORE)
        z = self.weight * difference + self.clear_weight * clear + self.intercept
        return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))


def with_differences(docs: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """``keep`` with (__all, __clear): each text's difference and the part of it from n-grams that speak clearly."""
    if model.untrained:
        return docs.select(*[col(c) for c in keep], F.lit(0.0).alias("__all"), F.lit(0.0).alias("__clear"))
    found = fields("__all double, __clear double")
    if model.table is not None:
        return map_columns(docs, ["text"], found, lambda t: list(model.differences_by_words(t).T), keep, GROUP_BYTES)
    return map_columns(docs, ["text"], found, lambda t: list(model.differences(t.to_pylist()).T), keep)


def known_labels(labels: DataFrame, label: str, use: Column) -> DataFrame:
    """(doc_id, label) of the labelled ids that ``use`` (a condition on doc_id) admits."""
    return (
        labels.select("doc_id", col(label).cast("int").alias("label"))
        .filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & use)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )


def label_lookup(known: DataFrame) -> Callable[[pa.Array], pa.Array]:
    """The label of each id, null for others, from sorted blocks: for labels of any number of documents."""
    blocks = sorted_blocks(known.sparkSession, known.select(F.col("doc_id").cast("long").alias("key"), "label"), "labels")

    def label_of(ids: pa.Array) -> pa.Array:
        wanted, at = np.unique(ids.drop_null().to_numpy().astype(np.int64), return_inverse=True)
        keys, labels = rows_at(blocks, wanted)
        row = np.searchsorted(keys, wanted)
        has = np.append(keys, 0)[row] == wanted
        has &= row < len(keys)
        found = np.zeros(len(ids), np.int32)
        valid = ids.is_valid().to_numpy(zero_copy_only=False)
        found[valid] = np.append(labels, 0)[row][at]
        valid[valid] = has[at]
        return pa.array(found, mask=~valid)

    return label_of


def train(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit on labelled rows whose crc32(doc_id) mod 4 is not 2.

    Labels of more than ``BROADCAST_ROWS`` documents are looked up by the tasks
    that count, and joined to the figures of the curve's texts, so no text is
    shuffled (but those of ids that are no integers).
    """
    spark = docs.sparkSession
    use = F.pmod(crc_of_id(), F.lit(4)) != 2
    part = F.pmod(F.xxhash64(F.lit("curve"), "doc_id"), F.lit(CALIBRATION_SHARE))
    training, known = docs.select("doc_id", "text").filter(use), known_labels(labels, "toxic", use)
    few, label_of = known.count() <= BROADCAST_ROWS, None
    if few or not all(isinstance(df.schema["doc_id"].dataType, T.IntegralType) for df in (docs, labels)):
        training = training.join(F.broadcast(known) if few else known.hint("merge"), "doc_id")
    else:
        label_of = label_lookup(known)
    counts = staged(spark, ngram_counts(training.filter(part != 0), label_of), "ngram-counts")
    seen = counts.agg(F.sum("toxic"), F.sum("ordinary"), F.count("*")).first()
    if not seen[0] or not seen[1]:
        return ToxicityModel()
    table = ratio_table(counts, seen[2])
    symbols = np.zeros(256, bool)
    symbols[[r[0] for r in counts.select(F.col("key").bitwiseAND(F.lit(255))).distinct().collect()]] = True
    if seen[2] <= BROADCAST_ROWS:  # there are at most as many histories as n-grams
        rows = table.toArrow().sort_by("key")
        ratios, keys = with_none(rows["key"].to_numpy(), [rows[c].to_numpy() for c in ("ratio", "clear")])
        model = ToxicityModel(spark.sparkContext.broadcast(ratios), keys=spark.sparkContext.broadcast(keys), symbols=symbols)
    else:
        model = ToxicityModel(table=sorted_blocks(spark, table, "ngram-ratios"), symbols=symbols)
    held = training.filter(part == 0).withColumn("__at", F.xxhash64("doc_id"))
    held = with_differences(held, model, ["__at", "doc_id"] if label_of else ["__at", "doc_id", "label"])
    if label_of:
        held = held.join(known.hint("merge"), "doc_id")
    curve = held.orderBy("__at", "doc_id", "__all", "__clear").limit(CALIBRATION_ROWS).select("__all", "__clear", "label").toPandas()
    x, y = curve[["__all", "__clear"]].to_numpy(float), (curve["label"] > 0).to_numpy(float)
    if 0 < y.sum() < len(y):
        w, model.intercept = fit_curve(np.append(x, np.zeros((NEUTRAL_ROWS, 2)), axis=0), np.append(y, np.zeros(NEUTRAL_ROWS)))
        model.weight, model.clear_weight = float(w[0]), float(w[1])
    else:  # too few rows for a curve: a plain one that asks for clear evidence
        model.weight, model.intercept = 10.0, float(np.log(UNTRAINED_SCORE / (1 - UNTRAINED_SCORE)))
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if the score reaches ``THRESHOLD``)."""
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("score", "predicted")]
    rows = with_differences(docs, model, kept)
    rows = rows.withColumn("score", model.score(F.col("__all"), F.col("__clear"))).drop("__all", "__clear")
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op2(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_toxicity(docs, train(docs, labels), ["doc_id"])
    return scored.select("doc_id", (F.pmod(crc_of_id(), F.lit(4)) == 2).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents of ``docs`` that the model does not reject, with their own columns."""
    model = train(docs, labels)
    kept = with_differences(docs, model, docs.columns)
    return kept.filter(model.score(F.col("__all"), F.col("__clear")) < THRESHOLD).select(*[col(c) for c in docs.columns])
