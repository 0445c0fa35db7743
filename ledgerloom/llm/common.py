"""What the text operators share: folds, words, bounded slices of Arrow batches."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerloom.session import scratch_path, scratch_root

#: A word: a run of ASCII digits, ASCII lower-case letters and anything outside ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What stands between words.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Texts of a batch that the pipeline sends to a Python worker.
BATCH_ROWS = 1_000
#: Bytes of UTF-8: A-Z to a-z, what belongs to no word to a blank.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def at_hand(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """At most so many rows in an Arrow batch of this session; a smaller number that is set stays.

    A batch is held whole by the executor and by the Python worker, and a row holds a whole text.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    at_hand(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(doc_id: str | Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo the number of folds; NULL for a NULL id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(folds))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read again: cuts the lineage, and lost executors cost nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the folder that all executors share."""
    scratch_root(df.sparkSession)
    return df.checkpoint()


def words(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8; NULL is empty."""
    values = pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.binary()), b"")
    return values.to_pylist()


def with_text(documents: DataFrame, keep: list[str]) -> tuple[DataFrame, str]:
    """Columns ``keep`` and, only if it is not a string among them, the text; with the name that holds the text."""
    if "text" in keep and documents.schema["text"].dataType == StringType():
        return documents.select(*keep), "text"
    return documents.select(*keep, F.col("text").cast("string").alias("__text")), "__text"


def slices(batch: pa.RecordBatch, column: str = "text", rows: int = 2048, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of at most so many rows, each closed once its texts reach so many bytes."""
    lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(
        zero_copy_only=False
    )
    start, held = 0, 0
    for i, n in enumerate(lengths):
        held += int(n)
        if held >= size or i + 1 - start >= rows:
            yield batch.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def spans(lengths: np.ndarray) -> np.ndarray:
    """Start of each run, and the end of the last."""
    ends = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=ends[1:])
    return ends


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[s:s+n] of every start and length, one after another."""
    ends = spans(lengths)
    take = np.arange(ends[-1], dtype=np.int64) + np.repeat(starts - ends[:-1], lengths)
    return flat[take]


def order_of(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Places in the order of two keys of non-negative numbers."""
    n = len(high)
    bits = [max(int(x.max()), 1).bit_length() if n else 0 for x in (high, low)]
    own = max(n, 1).bit_length()
    if sum(bits) + own > 62:
        return np.lexsort((low, high))
    packed = np.sort((((high << bits[1]) | low) << own) | np.arange(n))
    return packed & ((1 << own) - 1)


_HELD: dict[str, tuple[object, object]] = {}


def worker_cache(owner: str, key: object, make: Callable[[], object]):
    """What an operator keeps in its Python worker from task to task.

    One operator's at a time: Spark gives the workers of one stage to the next,
    and memory must not grow with the number of stages.
    """
    found = _HELD.get(owner)
    if found is None or found[0] != key:
        if _HELD:
            _HELD.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
        found = _HELD[owner] = (key, make())
    return found[1]


class Codes(dict):
    """Numbers for strings, and for each a run of integers made once by ``make``.

    Bounded: ``trim`` empties it when it holds more than ``most`` entries, or ``MOST_HELD`` letters and integers.
    """

    MOST_HELD = 16_000_000

    def __init__(self, make, dtype: str = "i", most: int = 300_000):
        from array import array

        super().__init__()
        self.make, self.most, self.dtype = make, most, dtype
        self.flat, self.sizes, self.letters = array(dtype), array("i"), 0

    def __missing__(self, key: bytes) -> int:
        run = self.make(key)
        self[key] = code = len(self.sizes)
        self.flat.extend(run)
        self.sizes.append(len(run))
        self.letters += len(key)
        return code

    def trim(self) -> None:
        if len(self) > self.most or self.letters + len(self.flat) > self.MOST_HELD:
            from array import array

            self.clear()
            self.flat, self.sizes, self.letters = array(self.dtype), array("i"), 0

    def runs(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All runs of the codes one after another, and the length of each."""
        sizes = np.array(self.sizes, np.int64)
        flat = np.array(self.flat, np.int64)
        lengths = sizes[codes]
        return gather(flat, spans(sizes)[:-1][codes], lengths), lengths
