"""Near-duplicate classes by Order MinHash and banded alignment.

A document is the sequence of its words.  Each sketch samples its
``SAMPLED`` minimum five-word shingles, every shingle labelled with its
occurrence number, under a hash of its own and keeps them in text order, so
equal sketches speak for small edit distance rather than for equal sets.
``SKETCHES`` sketches are taken.  Documents with an equal sketch value are
candidates: first each with the smallest id of that value.  Candidates are
verified by an alignment of their words, banded by the edits that
``SIMILARITY`` allows; similarity is 1 - edits / length of the longer.
Classes are the connected components of verified links, found by min-label
propagation over tables in the shared folder.  Members of one value that are
then of different classes are compared too, all with all, in tiles of at most
about ``TILE_ROWS`` rows a side: words that two texts cannot share rule most
pairs out, the rest are aligned, and only links are written.

Edits spread evenly at the allowed share leave no run of five words unchanged.
So a text also has ``CLOSE_SKETCHES`` sketches over runs of ``CLOSE_SHINGLE``
words, which only add candidates: each with the smallest id of the value, if
the links so far leave the two in different classes.  A pair whose shorter
text has fewer than ``MEDIUM`` words has ``MEDIUM_SKETCHES`` of them.

A text of fewer than ``SHORT`` words has few shingles, and one edit may
change them all.  It and the texts that can be similar to it have exact keys
besides: cut into one segment more than the pair's allowed edits, the shorter
text has a segment that stands unchanged in the longer one, about where it was.

Exact copies are joined on a digest of the whole text first; one of each goes
on to the sketches.

Defined cases: null and empty texts are never copies of anything; a text of
fewer than five words is one shingle; rows without an id belong to no class
(the result has none for them, the filter keeps them); rows that repeat an
id are one document, linked to whatever any of them is linked to, and the
filter keeps one row of each different text of a kept id; an empty table has
no classes; a very long text is sketched in blocks of ``BLOCK`` hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertally.llm.common import bounded_broadcast, col, fields, map_arrow, map_columns, pieces, staged, words_of

SHINGLE = 5
SAMPLED = 2
SKETCHES = 32
CLOSE_SHINGLE = 3
CLOSE_SKETCHES = 48
MEDIUM = 64  # words of the shorter text below which a pair has more sketches in common
MEDIUM_SKETCHES = 96
SIMILARITY = 0.8
MAX_ROUNDS = 40

BLOCK = 1 << 18  # hashes held at once
TILE_ROWS = 400  # rows of a tile's side, on average
TILE_WORDS = 500_000  # words of a tile's side, on average
FILTER_BITS = 2048  # bits that stand for a text's words
SHORT = 20  # words below which a text's candidates are exact

_LARGEST = np.uint64(2**64 - 1)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.default_rng(5).integers(1, 2**63, SKETCHES, np.int64).astype(np.uint64)
_CLOSE_SEEDS = np.random.default_rng(7).integers(1, 2**63, MEDIUM_SKETCHES, np.int64).astype(np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_numbers(text: str | None) -> np.ndarray:
    """A number for each word of a text."""
    words = words_of(text)
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def labelled_shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A hash of each shingle and its occurrence number, in text order."""
    n = max(1, len(words) - size + 1)
    h = np.zeros(n, np.uint64)
    for j in range(min(size, len(words))):
        h = _mix(h * _MULTIPLIER + words[j : j + n] + np.uint64(1))
    return _labelled(h)


def _labelled(h: np.ndarray) -> np.ndarray:
    """A hash of each hash and its occurrence number."""
    n = len(h)
    out = np.empty(n, np.uint64)
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    occurrence = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    out[order] = _mix(s + _MULTIPLIER * occurrence.astype(np.uint64))
    return out


def sketch(text: str | None) -> list[int] | None:
    """The sketch values of a text, None for a text without words."""
    words = word_numbers(text)
    if not len(words):
        return None
    return _sketch_values(labelled_shingles(words), _SEEDS)


def close_sketch(text: str | None) -> list[int]:
    """Sketch values over shorter shingles; none for texts whose pairs all have exact keys."""
    words = word_numbers(text)
    n = len(words)
    if n < SHORT:
        return []
    seeds = _CLOSE_SEEDS if n - allowed_edits(n) < MEDIUM else _CLOSE_SEEDS[:CLOSE_SKETCHES]
    return _sketch_values(labelled_shingles(words, CLOSE_SHINGLE), seeds)


def _sketch_values(shingles: np.ndarray, seeds: np.ndarray) -> list[int]:
    """Of each seed: a hash of the ``SAMPLED`` least shingles under it, in text order."""
    k = min(SAMPLED, len(shingles))
    picked = np.empty((len(seeds), k), np.int64)
    group = max(1, BLOCK // len(shingles))
    for s in range(0, len(seeds), group):
        h = (shingles[None, :] ^ seeds[s : s + group, None]) * _MULTIPLIER
        h ^= h >> np.uint64(32)
        h *= _MULTIPLIER
        rows = np.arange(len(h))
        for j in range(k):
            at = h.argmin(1)
            picked[s : s + group, j] = at
            h[rows, at] = _LARGEST
    picked.sort(1)  # text order
    value = seeds
    for j in range(k):
        value = _mix(value * _MULTIPLIER + shingles[picked[:, j]])
    return value.view(np.int64).tolist()


def short_keys(text: str | None) -> list[int]:
    """Keys of a short text, or of one that can be similar to a short one.

    Two similar texts share a key if the shorter has fewer than ``SHORT`` words.
    """
    words = words_of(text)
    n = len(words)
    if not n or n - allowed_edits(n) >= SHORT:
        return []
    keys = set()

    def add(shorter: int, longer: int, i: int, start: int, end: int) -> None:
        key = blake2b(b" ".join([b"%d %d %d" % (shorter, longer, i), *words[start:end]]), digest_size=8)
        keys.add(int.from_bytes(key.digest(), "big", signed=True))

    def cuts(shorter: int, longer: int) -> list[int]:
        segments = min(int(allowed_edits(longer)) + 1, shorter)
        return [shorter * i // segments for i in range(segments + 1)]

    longer = n
    while n < SHORT and longer - allowed_edits(longer) <= n:  # this text as the shorter one
        at = cuts(n, longer)
        for i, (s, e) in enumerate(zip(at, at[1:])):
            add(n, longer, i, s, e)
        longer += 1
    edits = int(allowed_edits(n))
    for shorter in range(max(1, n - edits), min(n, SHORT - 1) + 1):  # as the longer one
        at, more = cuts(shorter, n), n - shorter
        spare = (edits - more) // 2  # a shift is made and, up to the difference in length, undone
        for i, (s, e) in enumerate(zip(at, at[1:])):
            for start in range(max(0, s - spare), min(s + more + spare, n - (e - s)) + 1):
                add(shorter, n, i, start, start + e - s)
    return sorted(keys)


def edit_distance(a: list, b: list, limit: int) -> int | None:
    """Edits (insert, delete, replace) between two sequences, None if more than ``limit``.

    Banded alignment: for each number of edits, the furthest row reached on
    every diagonal of the band that can still end within the limit.
    """
    n, m = len(a), len(b)
    goal = m - n
    if abs(goal) > limit:
        return None
    far = {0: _slide(a, b, 0, 0)}
    for d in range(limit + 1):
        if d:
            reached = {}
            for k in range(max(-d, goal - limit + d), min(d, goal + limit - d) + 1):
                i = max(far.get(k, -2) + 1, far.get(k - 1, -2), far.get(k + 1, -2) + 1)
                i = min(i, n, m - k)
                if i >= max(0, -k):
                    reached[k] = _slide(a, b, i, k)
            far = reached
        if far.get(goal, -1) >= n:
            return d
    return None


def _slide(a: list, b: list, i: int, k: int) -> int:
    n = min(len(a), len(b) - k)
    step = 1
    while i < n and a[i] == b[i + k]:  # growing strides of equal elements, then back to one
        while i + step <= n and a[i : i + step] == b[i + k : i + k + step]:
            i += step
            step *= 2
        step = max(1, step // 4)
    return i


def allowed_edits(longer, least: float = SIMILARITY):
    """Edits between similar texts, the longer of ``longer`` words (a number or an array)."""
    return np.int64(longer * (1 - least) + 1e-9)


def similar(x: str | None, y: str | None, least: float = SIMILARITY) -> bool:
    """Whether at most a share ``1 - least`` of the longer text's words are edits."""
    a, b = words_of(x), words_of(y)
    if not a or not b:
        return False
    longer = max(len(a), len(b))
    limit = allowed_edits(longer, least)
    if abs(len(a) - len(b)) > limit:
        return False
    counts: dict = {}
    for w in a:
        counts[w] = counts.get(w, 0) + 1
    common = 0
    for w in b:
        left = counts.get(w, 0)
        if left:
            counts[w] = left - 1
            common += 1
    # Every word of the longer one that is not common is an edit at least.
    if longer - common > limit:
        return False
    return edit_distance(a, b, limit) is not None


def sketch_table(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, n_words, sketches, close) of the documents that have an id; digest null for empty texts."""

    def run(texts):
        texts = texts.to_pylist()
        values = [sketch(t) for t in texts]
        return [[len(words_of(t)) for t in texts], [v and v + short_keys(t) for v, t in zip(values, texts, strict=True)], [close_sketch(t) for t in texts]]

    rows = docs.select("doc_id", "text", F.expr("CASE WHEN text <> '' THEN md5(text) END").alias("digest")).filter(
        "doc_id IS NOT NULL"
    )
    return map_columns(rows, ["text"], fields("n_words int, sketches array<long>, close array<long>"), run, ["doc_id", "digest"])


def shared_values(reps: DataFrame, sketches: str = "sketches") -> DataFrame:
    """(value, doc_id, n_words, a, n): the values of the column ``sketches`` that several rows of ``reps`` have.

    ``a`` is the smallest id among the ``n`` rows with the value.
    """
    keys = reps.select("doc_id", "n_words", F.explode(sketches).alias("value"))
    several = keys.groupBy("value").agg(F.min("doc_id").alias("a"), F.count("*").alias("n")).filter("n > 1")
    return keys.join(several, "value")


def candidate_pairs(members: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b: each document with the smallest id of every sketch value it shares."""
    pairs = members.filter("a <> doc_id")
    return pairs.groupBy("a", F.col("doc_id").alias("b")).agg(F.first("n_words").alias("n_words"))


def close_pairs(reps: DataFrame, pairs: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` (a, b, n_words of b) whose numbers of words allow them to be similar."""
    sizes = reps.groupBy(F.col("doc_id").alias("a")).agg(F.max("n_words").alias("n_a"))
    near = pairs.join(sizes, "a").filter(F.least("n_a", "n_words") >= F.lit(SIMILARITY) * F.greatest("n_a", "n_words") - 1)
    return near.select("a", "b")


def pairs_apart(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` that ``classes`` (node, label) leaves in different classes."""
    for c in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("node").alias(c), F.col("label").alias(f"class_{c}")), c, "left")
    return pairs.filter("coalesce(class_a, a) <> coalesce(class_b, b)").select("a", "b")


def verified_links(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""
    sides = pairs.select(
        "a", "b", F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(0).alias("side")), F.struct(F.col("b").alias("id"), F.lit(1).alias("side")))).alias("x")
    ).select("a", "b", "x.id", "x.side")
    texts = docs.select(F.col("doc_id").alias("id"), "text").join(bounded_broadcast(sides), "id")
    both = texts.groupBy("a", "b").agg(
        *[F.max(F.when(F.col("side") == s, F.col("text"))).alias(f"text_{s}") for s in (0, 1)]
    )

    def run(x, y):
        return [[similar(s, t) for s, t in zip(x.to_pylist(), y.to_pylist(), strict=True)]]

    return map_columns(both, ["text_0", "text_1"], fields("linked boolean"), run, ["a", "b"]).filter("linked").select("a", "b")


def word_bits(words: np.ndarray) -> np.ndarray:
    """``FILTER_BITS`` bits, those of the words labelled with their occurrence numbers set."""
    bits = np.zeros(FILTER_BITS, bool)
    bits[_labelled(words) % np.uint64(FILTER_BITS)] = True
    return np.packbits(bits).view(np.uint64)


def tile_links(rows: list[tuple]) -> list[tuple[int, int]]:
    """Links (a, b) between rows (value, side, doc_id, class_id, sketches, text) of one tile, of different classes.

    Rows of side 0 are compared with those of side 1, or with one another if
    there are none.  Two rows are compared under the least value they share,
    and not at all once links have joined their classes.
    """
    sides = [np.array([i for i, r in enumerate(rows) if r[1] == s], np.int64) for s in (0, 1)]
    numbers = [word_numbers(r[5]) for r in rows]
    sizes, bits = np.array([len(x) for x in numbers]), np.array([word_bits(x) for x in numbers])
    classes, ids = np.array([r[3] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
    label = {int(c): int(c) for c in classes}
    values = [None] * len(rows)

    def root(c: int) -> int:
        while label[c] != c:
            label[c] = c = label[label[c]]
        return c

    out = []
    for at, i in enumerate(sides[0].tolist()):
        others = sides[1] if len(sides[1]) else sides[0][at + 1 :]
        others = others[(classes[others] != classes[i]) & (ids[others] != ids[i])]
        limit = allowed_edits(np.maximum(sizes[others], sizes[i]))
        near = np.abs(sizes[others] - sizes[i]) <= limit
        others, limit = others[near], limit[near]
        # A set bit that the other lacks is a word that the other lacks, so an edit at least.
        lacks = [np.bitwise_count(x).sum(1, dtype=np.int64) for x in (bits[i] & ~bits[others], bits[others] & ~bits[i])]
        for j in others[np.maximum(*lacks) <= limit].tolist():
            x, y = root(int(classes[i])), root(int(classes[j]))
            if x == y:
                continue
            for k in (i, j):
                if values[k] is None:
                    values[k] = set(rows[k][4])
            if min(values[i] & values[j]) == rows[i][0] and similar(rows[i][5], rows[j][5]):
                label[max(x, y)] = min(x, y)
                out.append((int(ids[i]), int(ids[j])))
    return out


def links_across(docs: DataFrame, reps: DataFrame, shared: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between members of a ``shared`` value that ``classes`` (node, label) leaves apart.

    A value's members are dealt into blocks, a class of many members into
    blocks of its own; a tile is two blocks, or one with itself.  No tile
    has two blocks of one class.
    """
    spark = docs.sparkSession
    known = shared.filter("n > 2").select("doc_id", "n_words", "value")  # two members have been compared
    known = known.join(classes.withColumnsRenamed({"node": "doc_id", "label": "class_id"}), "doc_id", "left")
    known = known.withColumn("class_id", F.coalesce("class_id", "doc_id"))
    apart = known.groupBy("value").agg(F.min("class_id").alias("x"), F.max("class_id").alias("y"))
    apart = apart.filter("x < y").select("value")
    members = staged(spark, known.join(apart, "value", "left_semi"), "members")

    sums = (F.sum("n").alias("n"), F.sum("words").alias("words"))
    per_class = members.groupBy("value", "class_id").agg(F.count("*").alias("n"), F.sum("n_words").alias("words"))
    alone = (F.col("n") >= TILE_ROWS) | (F.col("words") >= TILE_WORDS)
    pools = per_class.select("value", "class_id", "n", "words", F.when(alone, F.col("class_id")).alias("own"))
    pools = staged(spark, pools, "pools")
    blocks = pools.groupBy("value", "own").agg(*sums)
    blocks = blocks.select(
        "value", "own", F.least("n", F.greatest(F.ceil(F.col("n") / TILE_ROWS), F.ceil(F.col("words") / TILE_WORDS))).alias("parts")
    )
    parts = blocks.select("value", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    left, right = (parts.select("value", F.struct("own", "part").alias(c)) for c in ("l", "r"))
    tiles = left.join(right, "value").filter("l <= r AND (l.own IS NULL OR NOT l.own <=> r.own)")
    tiles = staged(spark, tiles.withColumn("tile", F.monotonically_increasing_id()), "tiles")
    sides = tiles.select("value", "tile", F.explode(F.expr("IF(l = r, array(struct(l AS block, 0 AS side)), array(struct(l AS block, 0 AS side), struct(r AS block, 1 AS side)))")).alias("x"))
    sides = sides.select("value", "tile", "x.side", F.coalesce("x.block.own", F.lit(0)).alias("own"), F.col("x.block.own").isNull().alias("mixed"), "x.block.part")

    dealt = members.join(pools.select("value", "class_id", "own"), ["value", "class_id"])
    dealt = dealt.join(blocks.withColumnRenamed("own", "of"), "value").filter("own <=> of")
    dealt = dealt.select(
        "value", "doc_id", "class_id", F.coalesce("own", F.lit(0)).alias("own"), F.col("own").isNull().alias("mixed"),
        F.pmod(F.xxhash64(F.lit("tile"), "doc_id"), "parts").alias("part"),
    ).distinct()
    dealt = dealt.join(sides, ["value", "own", "mixed", "part"]).select("value", "tile", "side", "doc_id", "class_id")

    needed = reps.join(members.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id", "digest"])
    texts = docs.select("doc_id", "text", F.md5("text").alias("digest")).filter("text <> ''")
    texts = texts.join(needed.select("doc_id", "digest", "sketches"), ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest"])
    rows = dealt.join(texts, "doc_id").select("tile", "value", "side", "doc_id", "class_id", "sketches", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, []

        def links() -> pa.RecordBatch:
            found = tile_links(held)
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        for b in pieces(batches):
            for t, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if t != tile:
                    if held:
                        yield links()
                    tile, held = t, []
                held.append(tuple(row))
        if held:
            yield links()

    return map_arrow(rows.repartition("tile").sortWithinPartitions("tile"), run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each connected component of undirected ``links`` (a, b).

    Each round takes the smallest label among the neighbours, then the label
    of that label; tables of two longs per node are written in between.
    """
    spark = links.sparkSession
    edges = staged(spark, links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label"))
    labels = staged(spark, labels, "labels")
    for _ in range(MAX_ROUNDS):
        near = (
            edges.join(labels.withColumnsRenamed({"node": "b", "label": "seen"}), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("seen").alias("seen"))
        )
        nearest = labels.join(near, "node").select("node", F.least("label", "seen").alias("next"), "label")
        jump = labels.withColumnsRenamed({"node": "next", "label": "far"})
        step = nearest.join(jump, "next").select("node", F.least("next", "far").alias("label"), (F.least("next", "far") < F.col("label")).alias("moved"))
        step = staged(spark, step, "labels")
        labels = step.select("node", "label")
        if step.filter("moved").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def duplicate_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id): the smallest id of each document's class, one row per distinct id."""
    spark = docs.sparkSession
    table = staged(spark, sketch_table(docs), "order-sketches")
    ids = table.select("doc_id", "digest")
    first = ids.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
    first = staged(spark, first, "copies")
    copies = first.filter("n > 1").select("digest", "rep")
    # A row that is not the first of its copies is left to its representative.
    reps = table.join(first.select(F.col("rep").alias("doc_id"), "digest"), ["doc_id", "digest"], "left_semi")
    shared = staged(spark, shared_values(reps.filter("sketches IS NOT NULL")), "shared-values")
    pairs = staged(spark, candidate_pairs(shared), "candidates")
    links = staged(spark, verified_links(docs, close_pairs(reps, pairs)), "links")
    same = ids.join(copies, "digest").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).filter("a <> b")
    found = components(links.unionByName(same))
    across = staged(spark, links_across(docs, reps.filter("sketches IS NOT NULL"), shared, found), "links")
    more = staged(spark, candidate_pairs(shared_values(reps, "close")), "candidates")
    more = staged(spark, pairs_apart(close_pairs(reps, more), found), "candidates")
    across = across.unionByName(staged(spark, verified_links(docs, more), "links"))
    if not across.isEmpty():
        known = found.select(F.col("label").alias("a"), F.col("node").alias("b")).filter("a <> b")
        found = components(known.unionByName(across))
    everyone = ids.select("doc_id").distinct()
    classes = everyone.join(found.withColumnsRenamed({"node": "doc_id", "label": "class_id"}), "doc_id", "left")
    return classes.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def op3(docs: DataFrame) -> DataFrame:
    classes = duplicate_classes(docs)
    return classes.withColumn("kept", F.col("doc_id") == F.col("class_id"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each class (the smallest id), with the columns of ``docs``; rows without an id stay.

    Rows that repeat a kept id are one document: of each of its texts one row
    stays, the least by its columns' JSON.
    """
    classes = staged(docs.sparkSession, duplicate_classes(docs), "classes")
    dropped = classes.filter("doc_id <> class_id").select("doc_id")
    kept = docs.join(bounded_broadcast(dropped), "doc_id", "left_anti").select(*[col(c) for c in docs.columns])
    repeated = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    repeated = staged(docs.sparkSession, repeated, "repeated-ids")
    if repeated.isEmpty():
        return kept
    once = kept.join(bounded_broadcast(repeated), "doc_id", "left_anti")
    several = kept.join(bounded_broadcast(repeated), "doc_id", "left_semi")
    row = F.struct(*[col(c) for c in docs.columns])
    several = several.groupBy("doc_id", F.md5("text")).agg(F.min_by(row, F.to_json(row)).alias("__row")).select("__row.*")
    return once.unionByName(several).select(*[col(c) for c in docs.columns])
