"""Exact top-k search by inner product: an impact-ordered index, score at a time.

Vectors are dealt to shards of ``SHARD_ROWS``.  A shard quantises its
components' magnitudes to ``LEVELS`` impacts and keeps a posting segment for
each impact: the places (vector, dimension) that have it, signs apart.  A block
of queries goes through the segments by descending impact and adds up scores
for all of the shard's vectors.  What a vector still lacks is bounded by its
unread remainder's norm times the query's norm (its norm is known after each
segment), so a query stops as soon as the bound proves that few vectors can
be among its best; those are scored again exactly, in integers.  The k-th best
exact score of the shards before is where the next shard's bound starts.

Equal vectors of a shard are one entry with its k + 1 least ids: no more of
them can be among anyone's best k.  So a vector that a third of all rows hold
is scored once a shard.

Every query (``vec_id`` divisible by ``every``) is held against all rows in
blocks: the index is one table, and a pass over it takes a group of query
blocks of at most ``GROUP_BYTES`` by broadcast.  More queries are more passes;
no vectors are exchanged for a search.

Defined cases: vectors that are null or hold null or non-finite components,
and rows with a null id, take no part; rows that share a query's id count as
the query's own; repeated rows are candidates, or queries, of their own;
vectors of unequal lengths are compared as if filled up with zeros; a score
beyond 64 bits is cut to the largest or smallest; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordertally.llm.common import col, map_arrow, staged

SCALE = 256
TOP = 5
SHARD_ROWS = 4096
BLOCK_QUERIES = 512
GROUP_BYTES = 32 << 20  # of query blocks in one pass over the index
LEVELS = 16
# A query stops when at most this share of a shard's vectors can be among its best.
FEW = 1 / 128
# Pairs that are scored exactly at once.
PAIRS = 1 << 16

_LIMITS = [(np.int16, 1 << 15), (np.int32, 1 << 31), (np.int64, 1 << 62)]


# --- vectors of a block or shard as one matrix --------------------------------


def matrix_of(vectors: list[list[float]]) -> np.ndarray:
    """Quantised vectors as rows, filled up with zeros, in the narrowest exact type."""
    width = max((len(v) for v in vectors), default=0)
    m = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        m[i, : len(v)] = v
    m = np.floor(m * SCALE)
    most = float(np.abs(m).max(initial=0.0))
    for kind, limit in _LIMITS:
        if most < limit:
            return m.astype(kind)
    return m  # whole numbers as doubles


def _packed(m: np.ndarray) -> tuple[bytes, str, int]:
    return m.tobytes(), m.dtype.str, m.shape[1]


def _unpacked(data: bytes, kind: str, width: int, rows: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(rows, width)


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of equally many rows; exact, and cut to 64 bits."""
    width = min(q.shape[1], x.shape[1])
    q, x = q[:, :width], x[:, :width]
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(width, 1)
    if most < 2**62:
        return np.einsum("ij,ij->i", q.astype(np.int64), x.astype(np.int64))
    whole = [sum(int(a) * int(b) for a, b in zip(r, s)) for r, s in zip(q.tolist(), x.tolist())]
    return np.array([min(max(w, -(2**63)), 2**63 - 1) for w in whole], np.int64)


# --- the index ------------------------------------------------------------------


def posting_segments(m: np.ndarray) -> list[tuple[float, np.ndarray]]:
    """(impact, places) by descending impact; a place is dimension * rows + row, below zero for negative components."""
    size = np.abs(m.astype(np.float64)).T  # by dimension, then row
    most = size.max(initial=0.0)
    if most == 0:
        return []
    step = max(1.0, most / LEVELS)
    level = np.floor(size / step + 0.5).astype(np.int64).ravel()
    flat = np.flatnonzero(level)
    order = flat[np.argsort(-level[flat], kind="stable")]
    negative = (m.T < 0).ravel()[order]
    places = np.where(negative, ~order, order).astype(np.int32)
    cuts = np.flatnonzero(np.diff(level[order])) + 1
    return [(float(level[p[0] if p[0] >= 0 else ~p[0]]) * step, p) for p in np.split(places, cuts) if len(p)]


INDEX = (
    "shard long, n int, kind string, width int, exact binary, ids array<long>, id_ends array<int>, "
    "impacts array<double>, postings array<binary>"
)


def _index_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for shard, ids, vectors in _groups(batches):
        m = matrix_of(vectors)
        order = np.argsort(np.array(ids, np.int64), kind="stable")
        m, ids = m[order], np.array(ids, np.int64)[order]
        rows = np.ascontiguousarray(m)
        whole = rows.view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1]))).ravel() if rows.shape[1] else np.zeros(len(rows), "V1")
        _, first, entry = np.unique(whole, return_index=True, return_inverse=True)
        by_entry = np.argsort(entry.ravel(), kind="stable")  # ids stay ascending within an entry
        ends = np.cumsum(np.bincount(entry.ravel(), minlength=len(first)))
        starts = np.concatenate([[0], ends[:-1]])
        kept = [ids[by_entry[s : min(e, s + TOP + 1)]] for s, e in zip(starts, ends)]
        m = np.ascontiguousarray(m[first])
        segments = posting_segments(m)
        data, kind, width = _packed(m)
        yield pa.RecordBatch.from_pydict(
            {
                "shard": [shard], "n": pa.array([len(m)], pa.int32()), "kind": [kind], "width": pa.array([width], pa.int32()),
                "exact": pa.array([data], pa.binary()), "ids": [np.concatenate(kept)],
                "id_ends": pa.array([np.cumsum([len(k) for k in kept])], pa.list_(pa.int32())),
                "impacts": pa.array([[i for i, _ in segments]], pa.list_(pa.float64())),
                "postings": pa.array([[p.tobytes() for _, p in segments]], pa.list_(pa.binary())),
            }
        )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list]]:
    """(number, ids, vectors) of rows that come sorted by number."""
    here, ids, vectors = None, [], []
    for b in batches:
        for number, i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            if number != here:
                if ids:
                    yield here, ids, vectors
                here, ids, vectors = number, [], []
            ids.append(i)
            vectors.append(v)
    if ids:
        yield here, ids, vectors


BLOCKS = "block long, q_n int, q_kind string, q_width int, q_exact binary, q_ids array<long>"


def _query_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, ids, vectors in _groups(batches):
        m = matrix_of(vectors)
        data, kind, width = _packed(np.ascontiguousarray(m))
        yield pa.RecordBatch.from_pydict(
            {
                "block": [block], "q_n": pa.array([len(m)], pa.int32()), "q_kind": [kind], "q_width": pa.array([width], pa.int32()),
                "q_exact": pa.array([data], pa.binary()), "q_ids": pa.array([ids], pa.list_(pa.int64())),
            }
        )


def _dealt(df: DataFrame, size: int, number: str) -> DataFrame:
    """Rows with a group number, groups of about ``size`` rows whatever their ids are, sorted by group."""
    groups = max(1, math.ceil(df.count() / size))
    at = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    return df.select(at.alias(number), "id", "vec").repartition(number).sortWithinPartitions(number)


# --- the search -----------------------------------------------------------------


class Shard:
    """A shard's entries, ids and segments, made ready for many query blocks."""

    def __init__(self, n: int, kind: str, width: int, exact: bytes, ids: list[int], id_ends: list[int], impacts, postings):
        self.exact = _unpacked(exact, kind, width, n)
        self.ids, self.ends = np.array(ids, np.int64), np.array(id_ends, np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]])
        self.by_id = np.argsort(self.ids, kind="stable")
        self.segments = []
        # Past this, sums of squares or products would leave the range of the bounds: all is scored exactly.
        self.bounded = np.abs(self.exact.astype(np.float64)).max(initial=0) < 1e15
        if not self.bounded:
            return
        rest = self.exact.astype(np.float64).T.copy()
        self.norm = np.sqrt((rest**2).sum(axis=0))
        self.kind = np.float32 if self.norm.max(initial=0) < 1 << 20 else np.float64
        for impact, data in zip(impacts, postings):
            places = np.frombuffer(data, np.int32)
            up, down = places[places >= 0], ~places[places < 0]
            flat = rest.reshape(-1)
            flat[up] -= impact
            flat[down] += impact
            self.segments.append((impact, up, down, np.sqrt((rest**2).sum(axis=0))))

    def entries_of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``ids``, entry) of the entries that hold these ids."""
        known = self.ids[self.by_id]
        low, high = np.searchsorted(known, ids, "left"), np.searchsorted(known, ids, "right")
        n = high - low
        at = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(np.arange(len(ids)), n), np.searchsorted(self.ends, self.by_id[at], "right")

    def scored(self, q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, entry, exact score) of every pair that may be among the query's best ``TOP``.

        ``floor`` holds scores that ``TOP`` vectors elsewhere are known to reach.
        """
        n = len(self.exact)
        found = []
        if not self.bounded or np.abs(q.astype(np.float64)).max(initial=0) >= 1e15:
            everything = np.repeat(np.arange(len(q)), n), np.tile(np.arange(n), len(q))
            return self._exactly(q, *everything)
        width = min(q.shape[1], self.exact.shape[1])
        norms = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
        active, weights = np.arange(len(q)), q[:, :width].astype(self.kind)
        sums = np.zeros((len(q), n), self.kind)
        # The sums' own rounding, far above what products of this size can lose.
        slack = norms * self.norm.max(initial=0) * 1e-5 + 1e-3
        last = math.inf
        for k, (impact, up, down, left) in enumerate(self.segments):
            dense = np.zeros((self.exact.shape[1], n), self.kind)
            dense.reshape(-1)[up] = impact
            dense.reshape(-1)[down] = -impact
            sums += weights @ dense[:width]
            bound = float(left.max())
            if k + 1 < len(self.segments) and bound > 0.7 * last:
                continue
            last = bound
            room = (norms[active, None] * left[None, :] + slack[active, None]).astype(self.kind)
            low = floor[active].astype(np.float64)
            if n >= TOP:
                sure = sums - room
                sure[self.entries_of(q_ids[active])] = -np.inf  # a query's own rows prove nothing
                reached = np.partition(sure, n - TOP, axis=1)[:, n - TOP]
                low = np.maximum(low, reached)
            able = sums + room >= low[:, None]
            done = (able.sum(axis=1) <= max(2 * TOP, FEW * n)) | (k + 1 == len(self.segments))
            if done.any():
                rows, entries = np.nonzero(able[done])
                found.append((active[done][rows], entries))
                active, weights, sums = active[~done], weights[~done], sums[~done]
            if not len(active):
                break
        if len(active):  # no segments: all components are zero
            found.append((np.repeat(active, n), np.tile(np.arange(n), len(active))))
        return self._exactly(q, np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))

    def _exactly(self, q, rows, entries):
        scores = [exact_scores(q[rows[i : i + PAIRS]], self.exact[entries[i : i + PAIRS]]) for i in range(0, len(rows), PAIRS)]
        return rows, entries, np.concatenate(scores) if scores else np.zeros(0, np.int64)


class Best:
    """The best candidates so far of a block's queries."""

    def __init__(self, n: int, kind: str, width: int, exact: bytes, ids: list[int]):
        self.q, self.q_ids = _unpacked(exact, kind, width, n), np.array(ids, np.int64)
        self.row = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.floor = np.full(n, -np.inf)

    def take(self, shard: Shard) -> None:
        rows, entries, scores = shard.scored(self.q, self.q_ids, self.floor)
        n_ids = (shard.ends - shard.starts)[entries]
        pick = np.repeat(shard.starts[entries], n_ids) + np.arange(n_ids.sum()) - np.repeat(np.cumsum(n_ids) - n_ids, n_ids)
        row, ids, score = np.repeat(rows, n_ids), shard.ids[pick], np.repeat(scores, n_ids)
        other = ids != self.q_ids[row]
        row = np.concatenate([self.row, row[other]])
        ids = np.concatenate([self.id, ids[other]])
        score = np.concatenate([self.score, score[other]])
        order = np.lexsort((ids, -score.astype(np.float64) if np.abs(score).max(initial=0) >= 2**62 else -score, row))
        row, ids, score = row[order], ids[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        kept = place < TOP
        self.row, self.id, self.score = row[kept], ids[kept], score[kept]
        full = place == TOP - 1
        self.floor[row[full]] = score[full]


FOUND = "block long, q_row int, query_id long, vec_id long, score long"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each query's best among the shards of a task."""
    best: dict[int, Best] = {}
    number, shard = None, None
    for b in batches:
        for i in range(b.num_rows):
            r = {f: b.column(k)[i] for k, f in enumerate(b.schema.names)}
            if r["shard"].as_py() != number:
                number = r["shard"].as_py()
                shard = Shard(*[r[c].as_py() for c in ("n", "kind", "width", "exact", "ids", "id_ends", "impacts", "postings")])
            block = r["block"].as_py()
            if block not in best:
                best[block] = Best(*[r[c].as_py() for c in ("q_n", "q_kind", "q_width", "q_exact", "q_ids")])
            best[block].take(shard)
    for block, found in best.items():
        n = len(found.row)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block] * n, pa.int64()), pa.array(found.row, pa.int32()), pa.array(found.q_ids[found.row], pa.int64()),
             pa.array(found.id, pa.int64()), pa.array(found.score, pa.int64())],
            ["block", "q_row", "query_id", "vec_id", "score"],
        )


def usable(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, vec) of the rows that take part."""
    fine: Column = F.forall(
        "vec", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))
    )
    rows = embeddings.select(col(id_col).cast("long").alias("id"), col(vector_col).cast("array<double>").alias("vec"))
    return rows.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & F.coalesce(fine, F.lit(False)))


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A row per shard of (id, vec) rows; one exchange, over all of them."""
    return map_arrow(_dealt(vectors, shard_rows, "shard"), _index_shards, INDEX)


def search(index: DataFrame, queries: DataFrame, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``TOP`` best of every (id, vec) row of ``queries``."""
    spark = index.sparkSession
    blocks = staged(spark, map_arrow(_dealt(queries, BLOCK_QUERIES, "block"), _query_blocks, BLOCKS), "search-queries")
    size = F.coalesce(F.sum(F.length("q_exact") + 8 * F.size("q_ids")), F.lit(0))
    size, last = blocks.agg(size, F.coalesce(F.max("block"), F.lit(0))).first()
    groups = max(1, math.ceil(size / group_bytes))
    found = None
    for g in range(groups):
        if g > last:
            break
        some = blocks.filter(F.pmod("block", F.lit(groups)) == g)
        # Every shard meets every query block of the group: the stated query set, in blocks of a bounded size.
        numbers = F.sequence(F.lit(g).cast("long"), F.lit(last).cast("long"), F.lit(groups).cast("long"))
        tiles = index.withColumn("block", F.explode(numbers)).join(F.broadcast(some), "block")
        part = staged(spark, map_arrow(tiles, _search, FOUND), "search-found") if groups > 1 else map_arrow(tiles, _search, FOUND)
        found = part if found is None else found.unionByName(part)
    return _ranked(found)


def _ranked(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("block", "q_row").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_k(embeddings: DataFrame, every: int = 50) -> DataFrame:
    """Each query's best candidates; queries are the rows whose id is divisible by ``every``."""
    spark = embeddings.sparkSession
    vectors = usable(embeddings)
    index = staged(spark, build_index(vectors), "search-index")
    return search(index, vectors.filter(F.col("id") % every == 0))


def op12(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings)
