"""Benchmark decontamination: prefix-filtered join of item windows with documents.

Every benchmark item gives windows of ten consecutive words (one shorter
window if it has fewer).  The words of a window are ordered by rarity, their
number of occurrences over all documents.  A document that contains a window
must contain its rarest word, the necessary prefix for full containment; so
documents are joined with the windows on that word alone.  A candidate is
dropped if the window, laid at the word's place, would reach outside the
document (positional and length bounds), and verified by exact comparison.

The window index is built from the benchmark in blocks of at most
``BLOCK_BYTES`` of text and broadcast block by block, so its size has a bound
however large the benchmark is; every block is matched against all documents
and the hits are united.

Defined cases: null and empty texts have no words and no hits; an item
without words has no window; repeated documents and items count each on their
own (an item id once per document); null item ids take part as hits but have
no name in the list of items; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertally.llm.common import col, fields, map_arrow, map_columns, pieces, staged, words_of

WINDOW = 10
BLOCK_BYTES = 16 << 20

Window = tuple[bytes, ...]


def item_windows(text: str | None, size: int = WINDOW) -> set[Window]:
    words = words_of(text)
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def benchmark_items(benchmark: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """(item, text, block) rows and the number of blocks, each of about half ``block_bytes`` of text."""
    items = benchmark.select(col("item_id").cast("string").alias("item"), "text").filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + 2 * total // block_bytes if total > block_bytes else 1
    return items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n))), n


def word_counts(docs: DataFrame, vocabulary) -> dict[bytes, int]:
    """Occurrences over all documents of the words in the broadcast ``vocabulary``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = vocabulary.value, Counter()
        for b in pieces(batches):
            for text in b.column(0).to_pylist():
                counts.update(filter(known.__contains__, words_of(text)))
        if counts:
            yield pa.RecordBatch.from_pydict(
                {"word": pa.array(list(counts), pa.binary()), "n": pa.array(list(counts.values()), pa.int64())}
            )

    rows = map_arrow(docs.select("text"), run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in rows.collect()}  # bounded by the block's vocabulary


def window_index(items: list[tuple], counts: dict[bytes, int]) -> dict:
    """Rarest word -> {(its place, window length) -> {window -> item ids}}."""
    index: dict = {}
    for item, text in items:
        for w in item_windows(text):
            at = min(range(len(w)), key=lambda i: (counts.get(w[i], 0), w[i], i))
            if counts.get(w[at], 0):  # else no document has the window
                index.setdefault(w[at], {}).setdefault((at, len(w)), {}).setdefault(w, set()).add(item)
    return index


def find_windows(words: list[bytes], index: dict) -> tuple[list[tuple[int, int]], set]:
    """Spans (start, end) of the words of index windows, and the ids of their items."""
    spans, items, n = set(), set(), len(words)
    for i, word in enumerate(words):
        places = index.get(word)
        if places is None:
            continue
        for (at, size), windows in places.items():
            start = i - at
            if start < 0 or start + size > n:
                continue
            found = windows.get(tuple(words[start : start + size]))
            if found:
                spans.add((start, start + size))
                items |= found
    return sorted(spans), items


def merged_spans(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


FOUND = "n_words long, span_starts array<long>, span_ends array<long>, items array<string>"


def _match_block(docs: DataFrame, block: list[tuple], keep: list[str] | None) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    vocabulary = sc.broadcast({w for _, text in block for w in words_of(text)})
    index = sc.broadcast(window_index(block, word_counts(docs, vocabulary) if block else {}))

    def run(texts):
        n, starts, ends, names = [], [], [], []
        for text in texts.to_pylist():
            words = words_of(text)
            spans, items = find_windows(words, index.value)
            spans = merged_spans(spans)
            n.append(len(words))
            starts.append([s for s, _ in spans])
            ends.append([e for _, e in spans])
            names.append(sorted(x for x in items if x is not None))
        return [n, starts, ends, names]

    return map_columns(docs, ["text"], fields(FOUND), run, keep)


def _merge(starts, ends, items):
    out = [[], [], []]
    for s, e, names in zip(starts.to_pylist(), ends.to_pylist(), items.to_pylist(), strict=True):
        spans = merged_spans(list(zip(s or [], e or [], strict=True)))
        out[0].append([x for x, _ in spans])
        out[1].append([x for _, x in spans])
        out[2].append(sorted(set(names or [])))
    return out


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Documents with ``n_words``, merged hit spans (in word positions) and the sorted item ids found.

    A benchmark of one block takes two passes over the documents (word
    counts, matching) and no shuffle of texts.  With more blocks, each
    block's hits are written under the text's hash, then united.
    """
    items, n = benchmark_items(benchmark, block_bytes)
    block = lambda k: [tuple(r) for r in items.filter(F.col("block") == k).select("item", "text").collect()]
    if n == 1:
        return _match_block(docs, block(0), keep)
    spark, key = docs.sparkSession, F.xxhash64(F.coalesce("text", F.lit("")))
    hits = None
    for k in range(n):
        found = _match_block(docs.select("text", key.alias("__key")), block(k), ["__key"])
        found = staged(spark, found.filter(F.size("span_starts") > 0).dropDuplicates(["__key"]), "window-hits")
        hits = found if hits is None else hits.unionByName(found)
    hits = hits.groupBy("__key").agg(
        *[F.flatten(F.collect_list(c)).alias(c) for c in ("span_starts", "span_ends", "items")]
    )
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("n_words", *hits.columns)]
    count = fields("n_words long")
    base = map_columns(
        docs.withColumn("__key", key), ["text"], count, lambda t: [[len(words_of(x)) for x in t.to_pylist()]], [*names, "__key"]
    )
    joined = base.join(hits, "__key", "left")  # no hits: null arrays, merged to empty ones
    spans = fields(FOUND)[1:]
    return map_columns(joined, [f.name for f in spans], spans, _merge, [*names, "n_words"])


def op10(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find_contamination(docs, benchmark, ["doc_id"])
    n_hit = F.aggregate(
        F.zip_with("span_starts", "span_ends", lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x
    )
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents of ``docs`` without any benchmark window, with their own columns."""
    # The row travels whole, so that no column of it can clash with those added.
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("__row"), "text")
    clean = find_contamination(rows, benchmark, ["__row"]).filter(F.size("span_starts") == 0)
    return clean.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])
