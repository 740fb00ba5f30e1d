"""Lexical retrieval packing: sequences of related documents, filled to the last token.

Documents become token ids followed by id 0.  They are sharded by their most
characteristic term; each shard holds a BM25 inverted index over its
documents (document frequencies and mean length are those of the whole
corpus).  Packing a shard, the index returns the unused neighbours of a seed
document; those that still fit go into the seed's window, best first, and the
best one left is cut to fill the window and becomes the next seed.  So every
window of ``WINDOW`` tokens is full; a shard's last tokens are cut into
sequences whose lengths are powers of two, which need no padding.

Shards are ranges of (term, id), so a term that very many documents share
spans several shards; a shard holds about ``SHARD_TOKENS`` tokens at most
(one document more), whatever the input.

Defined cases: a null text is empty, an empty text is the single id 0;
repeated rows and null ids are packed each as a document of its own; further
columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordertally.llm.common import fields, map_arrow, map_columns, staged

WINDOW = 1024
END_ID = 0
SHARD_TOKENS = 2_000_000
QUERY_TERMS = 16  # most characteristic terms that a seed shares with others, used as its query
NEIGHBOURS = 32  # unused neighbours looked at for one seed
K1, B = 1.2, 0.75
TOKENIZER = "byte_bpe_50k"
IDS = "<u2"  # the vocabulary has fewer than 65,536 ids
VOCABULARY = 1 << 16
SPECIAL = "<|endoftext|>"


@functools.cache
def tokenizer(name: str = TOKENIZER):
    """(fast encoder, reference encoder) of one vocabulary.

    The fast one reads the same vocabulary as ranks and gives the same ids;
    the reference one takes the rare texts with the special token's string.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return fast, Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))


def token_ids(text: str | None, name: str = TOKENIZER) -> np.ndarray:
    """Ids of a text and the end id."""
    if not text:
        return np.array([END_ID], IDS)
    fast, reference = tokenizer(name)
    if SPECIAL in text:
        ids = reference.encode(text, add_special_tokens=False).ids
    else:
        ids = fast.encode_ordinary(text)
    ids.append(END_ID)
    return np.array(ids, IDS)


def token_table(docs: DataFrame, name: str = TOKENIZER) -> DataFrame:
    """(doc_id, ids): ids as little-endian 16-bit numbers."""
    return map_columns(
        docs, ["text"], fields("ids binary"), lambda t: [[token_ids(x, name).tobytes() for x in t.to_pylist()]], ["doc_id"]
    )


def corpus_statistics(tokens: DataFrame) -> tuple[np.ndarray, int, int]:
    """(documents with each id, documents, tokens) over the whole corpus; the array has a fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, total = np.zeros(VOCABULARY, np.int64), 0, 0
        for b in batches:
            for x in b.column(0):
                ids = np.frombuffer(x.as_buffer(), IDS)
                df[np.unique(ids)] += 1
                docs, total = docs + 1, total + len(ids)
        at = np.flatnonzero(df)
        at, n = np.append(at, [-1, -2]), np.append(df[at], [docs, total])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n, pa.int64())], ["id", "n"])

    rows = map_arrow(tokens.select("ids"), run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    df, sums = np.zeros(VOCABULARY), {-1: 0, -2: 0}
    for r in rows:
        if r.id >= 0:
            df[r.id] = r.n
        else:
            sums[r.id] = r.n
    return df, sums[-1], sums[-2]


def inverse_frequencies(df: np.ndarray, docs: int) -> np.ndarray:
    return np.log1p((docs - df + 0.5) / (df + 0.5))


def terms_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids of a document (without the end id) and their counts."""
    return np.unique(ids[:-1], return_counts=True)


def characteristic_term(ids: np.ndarray, rarity: np.ndarray) -> int:
    """The document's rarest id that some other document has too, -1 for an empty document."""
    return int(ids[np.argmax(rarity[ids[:-1]])]) if len(ids) > 1 else -1


class ShardIndex:
    """BM25 inverted index of one shard's documents."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.n = len(docs)
        parts = [terms_of(d) for d in docs]
        sizes = [len(t) for t, _ in parts]
        terms = np.concatenate([t for t, _ in parts]).astype(np.int64) if parts else np.zeros(0, np.int64)
        tf = np.concatenate([c for _, c in parts]).astype(np.float64) if parts else np.zeros(0)
        of = np.repeat(np.arange(self.n), sizes)
        norm = K1 * (1 - B + B * np.repeat([len(d) for d in docs], sizes) / max(1.0, mean_length))
        impact = idf[terms] * tf * (K1 + 1) / (tf + norm)
        self.first = np.concatenate(([0], np.cumsum(sizes)))
        order = np.argsort(terms, kind="stable")
        self.posting_docs, self.posting_weights = of[order], impact[order]
        self.posting_at = np.searchsorted(terms[order], np.arange(VOCABULARY + 1))
        # A term that no other document of the shard has finds nothing.
        self.terms, self.weight = terms, np.where(np.diff(self.posting_at)[terms] > 1, impact, 0)

    def scores(self, seed: int) -> np.ndarray:
        """BM25 score of every document for the seed's most characteristic terms."""
        s, e = self.first[seed], self.first[seed + 1]
        best = s + np.argsort(-self.weight[s:e], kind="stable")[:QUERY_TERMS]
        best = best[self.weight[best] > 0]
        spans = [(self.posting_at[t], self.posting_at[t + 1]) for t in self.terms[best]]
        if not spans:
            return np.zeros(self.n)
        docs = np.concatenate([self.posting_docs[a:b] for a, b in spans])
        weights = np.concatenate([self.posting_weights[a:b] for a, b in spans])
        return np.bincount(docs, weights, self.n)

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Up to ``NEIGHBOURS`` unused documents that share a query term with the seed, best first."""
        score = np.where(unused, self.scores(seed), 0)
        if self.n > NEIGHBOURS:
            top = np.argpartition(-score, NEIGHBOURS - 1)[:NEIGHBOURS]
        else:
            top = np.arange(self.n)
        top = top[score[top] > 0]
        return top[np.lexsort((top, -score[top]))]


def packing_order(docs: list[np.ndarray], idf: np.ndarray, mean_length: float, window: int = WINDOW) -> list[int]:
    """The documents in the order in which they fill windows."""
    index = ShardIndex(docs, idf, mean_length)
    unused, order, used, following = np.ones(len(docs), bool), [], 0, 0

    def take(d: int) -> None:
        nonlocal used
        unused[d] = False
        order.append(d)
        used = (used + len(docs[d])) % window

    seed = None
    while len(order) < len(docs):
        if seed is None:
            while not unused[following]:
                following += 1
            seed = following
        take(seed)
        if not used:  # the window is full
            seed = None
            continue
        cut = None
        for d in index.neighbours(seed, unused).tolist():
            if len(docs[d]) <= window - used:
                take(d)
                if not used:
                    break
            elif cut is None:
                cut = d
        seed = cut if used else None
    return order


def sequences(sizes: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Pieces of documents of the given sizes laid one after the other.

    Returns (document's place, start in it, length, sequence, offset in it).
    Sequences have ``window`` tokens; the rest is cut at powers of two.
    """
    total = int(sizes.sum())
    rest = total % window
    tail = [1 << k for k in range(window.bit_length() - 1, -1, -1) if rest >> k & 1]
    begins = np.concatenate((np.arange(total // window) * window, total - rest + np.cumsum([0, *tail])[:-1])).astype(np.int64)
    doc_begins = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    cuts = np.union1d(begins, doc_begins)
    doc = np.searchsorted(doc_begins, cuts, side="right") - 1
    seq = np.searchsorted(begins, cuts, side="right") - 1
    return doc, cuts - doc_begins[doc], np.diff(np.append(cuts, total)), seq, cuts - begins[seq]


PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def pack_documents(docs: DataFrame, with_ids: bool = True, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Pieces of documents in sequences; ``ids`` (little-endian 32-bit) if asked for.

    Three steps: tokens are written once; corpus statistics are read from
    them; tokens are dealt to shards and packed.
    """
    spark = docs.sparkSession
    tokens = staged(spark, token_table(docs), "token-ids")
    df, n_docs, n_tokens = corpus_statistics(tokens)
    shared = spark.sparkContext.broadcast(inverse_frequencies(df, n_docs))
    rarity = spark.sparkContext.broadcast(np.where(df > 1, -df, -np.inf))
    mean_length = n_tokens / max(1, n_docs)
    schema = docs.select("doc_id").schema.fields + fields(PIECE.split(", ", 1)[1])
    schema = schema if with_ids else schema[:-1]

    def term(column):
        return [[characteristic_term(np.frombuffer(x.as_buffer(), IDS), rarity.value) for x in column]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 32

        def packed(doc_ids: list[pa.Array], shard: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            order = np.array(packing_order(shard, shared.value, mean_length))
            sizes = np.array([len(shard[i]) for i in order])
            doc, start, length, seq, offset = sequences(sizes)
            cut = [shard[order[d]][s : s + n].astype("<u4").tobytes() for d, s, n in zip(doc, start, length)]
            cols = [
                pa.concat_arrays(doc_ids).take(pa.array(order[doc])),
                start, length, [zlib.crc32(x) for x in cut], sizes[doc], seq + sequence, offset,
            ]
            cols = [cols[0], *[pa.array(x, pa.int64()) for x in cols[1:]]] + ([pa.array(cut, pa.binary())] if with_ids else [])
            sequence += int(seq[-1]) + 1
            batch = pa.RecordBatch.from_arrays(cols, [f.name for f in schema])
            for at in range(0, batch.num_rows, 10_000):
                yield batch.slice(at, 10_000)

        ids, shard, held = [], [], 0
        for b in batches:
            at = 0
            for i, x in enumerate(b.column(1)):
                shard.append(np.frombuffer(x.as_py(), IDS))
                held += len(shard[-1])
                if held >= shard_tokens:
                    yield from packed([*ids, b.column(0).slice(at, i + 1 - at)], shard)
                    ids, shard, held, at = [], [], 0, i + 1
            if at < b.num_rows:
                ids.append(b.column(0).slice(at))
        if shard:
            yield from packed(ids, shard)

    shards = max(1, round(n_tokens / shard_tokens))
    keyed = map_columns(tokens, ["ids"], fields("term int"), term)
    dealt = keyed.repartitionByRange(shards, "term", "doc_id", F.crc32("ids"))
    dealt = dealt.sortWithinPartitions("term", "doc_id", F.crc32("ids")).select("doc_id", "ids")
    return map_arrow(dealt, run, StructType(schema))


def op4(docs: DataFrame) -> DataFrame:
    return pack_documents(docs, with_ids=False)
