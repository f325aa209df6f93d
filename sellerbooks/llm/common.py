"""Helpers the corpus operators share: row ids, Arrow batches as byte arrays, hashing, ranks over salted groups.

A text column reaches Python as an Arrow array whose UTF-8 bytes lie in one buffer.
``text_blocks`` cuts it into blocks of whole documents of a bounded number of bytes,
so that memory depends on the block and on the longest single document only.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sellerbooks.session import materialise

ROW = "_row"
BLOCK_BYTES = 1 << 20
U64 = np.uint64
# An odd multiplier for byte sums and the mixing constants of a 64-bit finalizer.
BASE = 0x9E3779B97F4A7C15
MIX_A, MIX_B = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53


#: Rows of an Arrow batch. Texts and pages are long: Spark's default of 10,000 rows would
#: hold tens of megabytes a batch, several times over in the JVM and the worker.
BATCH_ROWS = 1000


def ship_package(spark) -> None:
    """Make a session ready: small Arrow batches, and this package on executors that do not have it installed."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_sellerbooks_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="sellerbooks-code-")) / "sellerbooks-code.zip"
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(target))
    context._sellerbooks_shipped = True


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_row(df: DataFrame, *columns: Column) -> DataFrame:
    """The given columns and a row id. The id follows the input files, so a lost task makes the same ids again."""
    return df.select(F.monotonically_increasing_id().alias(ROW), *columns)


def numbered(df: DataFrame) -> DataFrame:
    """(_row, doc): the row id and the whole row as one struct, so that no column of the input can clash with a helper's.

    Another scan may number otherwise, as splits follow the cores there are when it is
    planned. Where ids are met again in a later step, number once and ``materialise``.
    """
    return df.select(F.monotonically_increasing_id().alias(ROW), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc"))


#: Bits of a row id that hold the row's place in its file.
FILE_BITS = 40


def numbered_in_files(docs: DataFrame) -> DataFrame:
    """Like ``numbered`` for a table that is read from Parquet files as it lies there, with ids that any scan finds again.

    The id is the file's number, in order of paths, and the row's place in the file, so
    nothing needs to be written. A table that comes from no files is numbered and written.
    """
    if "_metadata" in docs.columns:
        return materialise(numbered(docs))
    try:
        paths = docs.select(F.col("_metadata.file_path").alias("_path")).distinct()
        place = docs.select(
            F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_place"),
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        )
    except AnalysisException:
        return materialise(numbered(docs))
    files = [(r["_path"], n) for n, r in enumerate(paths.sort("_path").collect())]
    files = docs.sparkSession.createDataFrame(files, "_path string, _number long")
    row = F.shiftleft("_number", FILE_BITS).bitwiseOR(F.col("_place"))
    return place.join(F.broadcast(files), "_path").select(row.alias(ROW), "doc")


def spread(df: DataFrame, columns: Sequence[str], text: Column | None = None) -> list[Column]:
    """The columns of ``doc`` again, with ``text`` in place of the text."""
    return [text.alias(c) if text is not None and c == "text" else F.col(f"doc.`{c}`").alias(c) for c in columns]


def as_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text array and its n + 1 offsets into them; NULL is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) or pa.types.is_large_string(array.type) else b"")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, places, values = array.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(places, dtype=kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data, offsets


def text_blocks(array: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) of runs of whole texts of about ``most`` bytes; a longer text is a run of its own."""
    if not len(array):
        return
    data, offsets = as_bytes(array)
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def byte_class(pattern) -> np.ndarray:
    return np.array([bool(pattern(b)) for b in range(256)])


#: Words of letters, digits and everything beyond ASCII.
ALNUM = byte_class(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
#: Words between blanks, tabs and line breaks.
SOLID = byte_class(lambda b: b != 32 and not 9 <= b <= 13)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def word_spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and each word's document. A word never crosses documents."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = kind[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data) + 1, dtype=bool)
    before[0], before[1:] = False, inside
    begins = inside & (~before[:-1] | edge[:-1])
    follows = np.empty(len(data), dtype=bool)
    follows[:-1], follows[-1] = inside[1:], False
    finishes = inside & (~follows | edge[1:])
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(finishes) + 1
    per_doc = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, np.repeat(np.arange(len(offsets) - 1), per_doc)


def one_blank_apart(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with one blank between neighbours of a document: bytes, starts and ends."""
    keep = kind[data]
    keep[ends[ends < len(data)]] = True
    place = np.cumsum(keep) - 1
    packed = data[keep]
    starts, ends = place[starts], place[ends - 1] + 1
    begins = np.zeros(len(packed) + 1, dtype=bool)
    begins[starts] = True
    gaps = ends[ends < len(packed)]
    packed[gaps[~begins[gaps]]] = 32
    return packed, starts, ends


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the value moves every bit of the result."""
    h = h ^ (h >> U64(33))
    h = h * U64(MIX_A)
    h = h ^ (h >> U64(33))
    h = h * U64(MIX_B)
    return h ^ (h >> U64(33))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        size = max(n, 2 * BLOCK_BYTES)
        known = np.full(size, base, dtype=U64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if size > 8 * BLOCK_BYTES:  # a single very long text
            return known
        _POWERS[base] = known
    return known[:n]


def prefix_sums(data: np.ndarray, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """S[i], the sum of byte times base ** place below i, and the inverse powers, modulo 2 ** 64."""
    n = len(data)
    sums = np.zeros(n + 1, dtype=U64)
    values = data.astype(U64)
    values += U64(1)
    np.cumsum(values * _powers(base, n), out=sums[1:])
    return sums, _powers(pow(base, -1, 1 << 64), n + 1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """A 64-bit hash of each span of bytes, equal for equal bytes wherever they stand."""
    sums, inverse = prefix_sums(data, base)
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(U64))


def pairs_to_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def chunk_of(parts: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(parts)).cast("int")


def before_in_group(
    df: DataFrame, keys: Sequence[str], value: Column, order_by: Sequence[Column], parts: int, salt: Sequence[str], name: str
) -> DataFrame:
    """Add the sum of ``value`` over the rows of the group that come before this one.

    A group is cut into ``parts`` chunks by a hash of ``salt``; rows are ordered by
    chunk, then by ``order_by`` within it. Chunk totals, at most ``parts`` a group,
    carry the sum forward, so no task sorts more than one chunk of a group.
    """
    rows = df.withColumn("_chunk", chunk_of(parts, *salt)).withColumn("_value", value)
    totals = rows.groupBy(*keys, "_chunk").agg(F.sum("_value").alias("_total"))
    over_chunks = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    marks = [f"_b{i}" for i in range(len(keys))]
    earlier = totals.select(
        *[F.col(k).alias(m) for k, m in zip(keys, marks)],
        F.col("_chunk").alias("_c"),
        F.coalesce(F.sum("_total").over(over_chunks), F.lit(0)).alias("_earlier"),
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    same = F.col("_chunk") == F.col("_c")
    for k, m in zip(keys, marks):
        same &= F.col(k).eqNullSafe(F.col(m))
    joined = rows.join(earlier, same, "left")
    return joined.withColumn(name, (F.col("_earlier") + F.col("_inside")).cast("long")).drop(
        "_chunk", "_value", "_inside", "_earlier", "_c", *marks
    )
