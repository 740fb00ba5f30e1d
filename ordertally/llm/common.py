"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import ordertally
from ordertally.session import scratch_path

# Upper bound on the rows of a side that may be broadcast.  Every side that
# is checked against it has at most four fixed-width columns, so the bound is
# one of bytes as well: 32 MB of data.
BROADCAST_ROWS = 1_000_000

# Rows that a Python worker turns into objects at once.
PIECE_ROWS = 500

# Byte translation that lower-cases A-Z, keeps 0-9, a-z and every non-ASCII
# byte, and turns the rest into spaces.
_WORD_BYTES = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """Words (UTF-8) of a text: runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.encode().translate(_WORD_BYTES).split() if text else []


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else as it is.

    For narrow fixed-width tables.  Joins give the same rows either way; the
    count is an aggregate, so no row reaches the driver.
    """
    return F.broadcast(df) if df.count() <= max_rows else df.hint("merge")


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps before.
    """
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Rows of an Arrow batch between the JVM and a Python worker.  Documents are
# long rows: Spark's default of 10,000 would hold tens of MB on either side.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

_SHIPPED: set[str] = set()  # applications whose workers have the package


def map_arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``mapInArrow`` whose Python workers can import this package wherever they run.

    The package's sources go to the executors once per application, as a
    small archive served by the driver.  The session's Arrow batches are
    lowered to ``BATCH_ROWS`` rows if they are larger.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_SETTING, "10000")) <= BATCH_ROWS:
        conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = Path(ordertally.__file__).resolve().parent
        archive = os.path.join(tempfile.mkdtemp(prefix="ordertally-src-"), "ordertally_src.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(archive)
        _SHIPPED.add(sc.applicationId)
    return df.mapInArrow(fn, schema)


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches in pieces of at most ``PIECE_ROWS`` rows, so that few rows at a time are Python objects."""
    for b in batches:
        for at in range(0, b.num_rows, PIECE_ROWS):
            yield b.slice(at, PIECE_ROWS)


def groups(batches: Iterator[pa.RecordBatch], group_bytes: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches put together until they have ``group_bytes`` or more; at most one piece more than that."""
    held, size = [], 0
    for b in pieces(batches):
        held.append(b)
        size += b.nbytes
        if size >= group_bytes:
            held, size, whole = [], 0, pa.concat_batches(held)
            yield whole
    if held:
        yield pa.concat_batches(held)


def map_columns(
    df: DataFrame,
    inputs: list[str],
    fields: list[T.StructField],
    fn: Callable[..., list],
    keep: list[str] | None = None,
    group_bytes: int = 0,
) -> DataFrame:
    """Append columns that ``fn`` computes from Arrow arrays of the ``inputs`` columns.

    ``keep`` names the columns of ``df`` to carry over (all by default).  A
    carried column whose name equals a new one, whatever its case, is
    replaced.  ``fn`` gets one Arrow array per input and returns one list or
    array per field; row order and count stay.  It gets a piece at a time, or
    with ``group_bytes`` about so many bytes of rows.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    used = kept + [c for c in inputs if c not in kept]
    at = [used.index(c) for c in inputs]
    src = df.select(*[col(c) for c in used])
    schema = T.StructType([src.schema[used.index(c)] for c in kept] + fields)
    types = [_arrow_type(f.dataType) for f in fields]
    names = kept + [f.name for f in fields]
    n = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in groups(batches, group_bytes) if group_bytes else pieces(batches):
            if b.num_rows:
                got = fn(*[b.column(i) for i in at])
                cols = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(got, types, strict=True)]
                yield from pieces([pa.RecordBatch.from_arrays([b.column(i) for i in range(n)] + cols, names)])

    return map_arrow(src, run, schema)


def _arrow_type(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow_type(t.elementType))
    if isinstance(t, T.StructType):
        return pa.struct([(f.name, _arrow_type(f.dataType)) for f in t.fields])
    return {
        T.StringType: pa.string(),
        T.LongType: pa.int64(),
        T.IntegerType: pa.int32(),
        T.DoubleType: pa.float64(),
        T.BooleanType: pa.bool_(),
        T.BinaryType: pa.binary(),
    }[type(t)]


def fields(spec: str) -> list[T.StructField]:
    """Struct fields from a DDL string."""
    return list(T.StructType.fromDDL(spec).fields)


def crc_of_id(name: str = "doc_id") -> Column:
    """crc32 of the id's decimal text (of the empty text for a null id)."""
    return F.crc32(F.coalesce(col(name).cast("string"), F.lit("")).cast("binary"))
