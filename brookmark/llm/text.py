"""Helpers the operators here share: words, hashes, Arrow columns, packed texts and staged frames."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmark.session import shared_dir

#: White space that parts words and is stripped from lines (fixed value of the contracts).
SPACE = b" \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_digest = xxhash.xxh3_64_intdigest
_MIX = np.uint64(0x9E3779B97F4A7C15)


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Arrow batches of few rows, since one row may be a very long text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Write a frame that later jobs read again into the shared folder; cuts its lineage as well."""
    folder = f"{shared_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


#: Column that carries what an operator does not read.
CARRIED = "carried"


def carried(docs: DataFrame, *own: str) -> DataFrame:
    """The named columns and all others in one struct, so that no name an operator adds can clash with theirs."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    return docs.select(*own, (F.struct(*rest) if rest else F.lit(True)).alias(CARRIED))


def restored(made: DataFrame, docs: DataFrame, *own: str) -> DataFrame:
    """The columns as they were before ``carried``."""
    return made.select(*[F.col(c) if c in own else F.col(f"{CARRIED}.`{c}`").alias(c) for c in docs.columns])


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    """Remainder of the checksum that parts training rows from held-out ones."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def raw(column: pa.Array) -> list[bytes | None]:
    """Texts of an Arrow column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def map_batches(
    df: DataFrame, per_batch: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch] | pa.RecordBatch], schema: str
) -> DataFrame:
    """Apply a function to each Arrow batch; its state ends with the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = per_batch(batch)
                yield from [out] if isinstance(out, pa.RecordBatch) else out

    return df.mapInArrow(run, schema)


def batch_of(**columns) -> pa.RecordBatch:
    """Record batch of arrays; numpy arrays and lists are converted."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns)
    )


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(_digest, words), np.uint64, len(words))


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k values; depends on the values and their order only.

    Built by doubling: the hash of 2m values mixes the hashes of its halves, so that it takes
    about 2 log2(k) vector operations and equal runs have equal hashes wherever they stand.
    """
    n = len(h) - k + 1
    if n <= 0:
        return h[:0]
    out, done, power, size = None, 0, h, 1
    while True:
        if k & size:
            part = power[done : done + n]
            out = part.copy() if out is None else mix(out, part)
            done += size
        if done == k:
            return out
        power = mix(power[:-size], power[size:])
        size *= 2


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-dependent mix of two hash arrays."""
    with np.errstate(over="ignore"):
        x = (a ^ (a >> np.uint64(31))) * _MIX + b
        x ^= x >> np.uint64(29)
        return x * np.uint64(0xBF58476D1CE4E5B9)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def packed(docs: DataFrame, *ids: str, name: str = "packed") -> DataFrame:
    """Texts compressed for a shuffle: the given columns and ``name`` (null texts stay null)."""
    frame = docs.select(*ids, F.col("text"))
    kinds = ", ".join(f"`{n}` {t}" for n, t in frame.dtypes[:-1])

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        texts = [None if t is None else squeeze(t) for t in raw(batch.column(len(ids)))]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.binary())], names=[*ids, name])

    return map_batches(frame, pack, ", ".join(x for x in (kinds, f"`{name}` binary") if x))


def unpack(column: pa.Array) -> list[bytes | None]:
    return list(unpack_each(column))


def unpack_each(column: pa.Array) -> Iterator[bytes | None]:
    """The texts one at a time."""
    expand = zstandard.ZstdDecompressor().decompress
    for t in column:
        yield None if not t.is_valid else expand(t.as_buffer())


def sliced(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
