"""What several of the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters between words (fixed value): space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 5
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """Remainder of the CRC-32 of the id as text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def column_or(batch: pa.RecordBatch, name: str, default: str = "") -> list[str]:
    """A text column as a list, nulls replaced."""
    return [default if x is None else x for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix, so that sums of word codes spread over the whole range."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX_1
    x ^= x >> np.uint64(27)
    x *= _MIX_2
    x ^= x >> np.uint64(31)
    return x


class WordCodes(dict):
    """64-bit code of each word; forgets all words when there are many."""

    LIMIT = 100_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


def shingles(text: str | None, codes: WordCodes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit codes of a text's word shingles.

    Words are lower-cased in A-Z only.  Fewer than ``size`` words make one shingle,
    no word makes none.
    """
    # bytes.lower and bytes.split know ASCII only, which is the rule for words here.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(ids))
    count = len(ids) - width + 1
    total = np.full(count, width, np.uint64)
    for k in range(width):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + count])
    return np.unique(total)


#: Bytes of a batch that Python objects are made of at a time.
SLICE_BYTES = 2 << 20


def in_batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in smaller batches: a batch of long texts becomes many."""
    for batch in batches:
        yield from _halves(batch, rows)
        pa.default_memory_pool().release_unused()


def _halves(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    if batch.num_rows > 1 and (batch.num_rows > rows or batch.nbytes > SLICE_BYTES):
        half = batch.num_rows // 2
        yield from _halves(batch.slice(0, half), rows)
        yield from _halves(batch.slice(half), rows)
    elif batch.num_rows:
        yield batch
