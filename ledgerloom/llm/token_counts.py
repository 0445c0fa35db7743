"""Token counts without token ids.

Every document becomes frequencies of its pre-tokens.  The frequencies meet the
piece counts, made once per distinct pre-token, in the partition of the
pre-token; only sums go back to the documents.

The documents of an Arrow slice travel as one *sheaf*: each pre-token names
the documents of the sheaf that hold it and how often, and all pre-tokens of one
bucket (by their hash) travel in one row per sheaf.  Pre-tokens that are pieces
of the vocabulary (a fixed number) are added up at once.  A pre-token of many
documents in a sheaf is dealt over several partitions by sheaf.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import at_hand, gather, slices, spans, texts_of
from ledgerloom.llm.tokenizing import pre_tokenizer, tokenizer_path

#: Partitions over which a pre-token of many documents is dealt.
SALTS = 16
#: Buckets for each shuffle partition.
BUCKETS = 4
_SHEAF = (
    "sheaf long, part int, token array<string>, held array<int>, place array<int>, times array<int>, "
    "doc_id array<long>, n_bytes array<long>"
)
_FIELDS = pa.schema(
    [
        ("sheaf", pa.int64()),
        ("part", pa.int32()),
        ("token", pa.list_(pa.string())),
        ("held", pa.list_(pa.int32())),
        ("place", pa.list_(pa.int32())),
        ("times", pa.list_(pa.int32())),
        ("doc_id", pa.list_(pa.int64())),
        ("n_bytes", pa.list_(pa.int64())),
    ]
)


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


class _Seen(dict):
    """Numbers of the pre-tokens this Python worker has met, with their spelling and known count (or -1)."""

    def __init__(self, path: str, most: int = 400_000):
        super().__init__()
        self.tok, self.most = pre_tokenizer(path), most
        self.fixed = self.tok.known()
        self.names: list[str] = []
        self.known, self.hash = array("i"), array("L")

    def __missing__(self, token: bytes | str) -> int:
        name = self.tok.spelled(token)
        self[token] = code = len(self.names)
        self.names.append(name)
        self.known.append(self.fixed.get(name, -1))
        self.hash.append(zlib.crc32(name.encode()))
        return code

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()
            self.names, self.known, self.hash = [], array("i"), array("L")


@lru_cache(maxsize=2)
def _seen(path: str) -> _Seen:
    return _Seen(path)


def _bind(path: str, buckets: int):
    """Documents to sheaves: a head row with ids, sizes and known counts, then the other pre-tokens, a row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _seen(path)
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in slices(batch):
                sheaf = (task << 32) + number
                number += 1
                seen.trim()
                texts = texts_of(piece)
                names, held, counts = seen.tok.pre_tokens(texts)
                own = np.fromiter(map(seen.__getitem__, names), np.int64, len(names))
                n = piece.num_rows
                doc = np.repeat(np.arange(n), counts)
                key, times = np.unique((own[held] << 32) | doc, return_counts=True)
                code, place = key >> 32, key & 0xFFFFFFFF
                known = np.array(seen.known, np.int64)[code]
                base = np.bincount(place, np.where(known < 0, 0, known * times), n).astype(np.int64)
                here = np.arange(n)
                ids = piece.column(piece.schema.get_field_index("doc_id"))
                sizes = np.fromiter(map(len, texts), np.int64, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([sheaf]),
                        pa.array([sheaf % buckets], pa.int32()),
                        pa.nulls(1, pa.list_(pa.string())),
                        pa.nulls(1, pa.list_(pa.int32())),
                        _lists(here, np.array([0, n]), pa.int32()),
                        _lists(base, np.array([0, n]), pa.int32()),
                        pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), ids.cast(pa.int64())),
                        _lists(sizes, np.array([0, n]), pa.int64()),
                    ],
                    schema=_FIELDS,
                )
                code, place, times = (x[known < 0] for x in (code, place, times))
                first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else code
                if not len(code):
                    continue
                held_by = np.diff(np.r_[first, len(code)])
                codes = code[first]
                salt = np.where(held_by * SALTS >= max(n, 64), 1 + sheaf % SALTS, 0)
                bucket = (np.array(seen.hash, np.int64)[codes] + salt * 7919) % buckets
                order = np.argsort(bucket, kind="stable")
                bucket, codes, starts, held_by = (x[order] for x in (bucket, codes, first, held_by))
                ends = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)]
                reach = spans(held_by)[ends]
                count = len(ends) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(count, sheaf)),
                        pa.array(bucket[ends[:-1]], pa.int32()),
                        _lists(np.array([seen.names[c] for c in codes.tolist()], object), ends, pa.string()),
                        _lists(held_by, ends, pa.int32()),
                        _lists(gather(place, starts, held_by), reach, pa.int32()),
                        _lists(gather(times, starts, held_by), reach, pa.int32()),
                        pa.nulls(count, pa.list_(pa.int64())),
                        pa.nulls(count, pa.list_(pa.int64())),
                    ],
                    schema=_FIELDS,
                )

    return run


def _count(path: str):
    """Piece counts, once per distinct pre-token of the partition, times frequencies; sums per document leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = pre_tokenizer(path)
        pieces: dict[str, int] = {}
        for batch in batches:
            token = batch.column(2)
            head = token.is_null()
            yield batch.filter(head)
            rows = batch.filter(pa.compute.invert(head))
            if not rows.num_rows:
                continue
            if len(pieces) > 500_000:
                pieces.clear()
            tokens = rows.column(2).flatten().to_pylist()
            counts = np.empty(len(tokens), np.int64)
            for i, p in enumerate(tokens):
                n = pieces.get(p)
                if n is None:
                    n = pieces[p] = tok.pieces(p)
                counts[i] = n
            place = rows.column(4).flatten().to_numpy()
            times = rows.column(5).flatten().to_numpy()
            held = rows.column(3).flatten().to_numpy()
            width = pa.compute.list_value_length(rows.column(2)).to_numpy()
            sheaf = np.repeat(np.repeat(rows.column(0).to_numpy(), width), held)
            value = np.repeat(counts, held) * times
            order = np.lexsort((place, sheaf))
            sheaf, place, value = sheaf[order], place[order], value[order]
            first = np.flatnonzero(np.r_[True, (sheaf[1:] != sheaf[:-1]) | (place[1:] != place[:-1])])
            sheaf, place, value = sheaf[first], place[first], np.add.reduceat(value, first)
            ends = np.r_[np.flatnonzero(np.r_[True, sheaf[1:] != sheaf[:-1]]), len(sheaf)]
            n = len(ends) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(sheaf[ends[:-1]]),
                    pa.array(np.zeros(n), pa.int32()),
                    pa.nulls(n, pa.list_(pa.string())),
                    pa.nulls(n, pa.list_(pa.int32())),
                    _lists(place, ends, pa.int32()),
                    _lists(value, ends, pa.int32()),
                    pa.nulls(n, pa.list_(pa.int64())),
                    pa.nulls(n, pa.list_(pa.int64())),
                ],
                schema=_FIELDS,
            )

    return run


def _unbind(group: pa.Table) -> pa.Table:
    """A sheaf's head and sums to one row per document."""
    heads = group.filter(pa.compute.is_valid(group["doc_id"]))
    ids = heads["doc_id"].combine_chunks().flatten()
    total = np.zeros(len(ids), np.int64)
    place = group["place"].combine_chunks().flatten().to_numpy()
    np.add.at(total, place, group["times"].combine_chunks().flatten().to_numpy())
    return pa.table(
        {"doc_id": ids, "n_bytes": heads["n_bytes"].combine_chunks().flatten(), "n_tokens": pa.array(total)}
    )


def token_counts(documents: DataFrame, path: str | None = None, limit: int = 2048) -> DataFrame:
    """Tokens per document: ``doc_id, n_bytes, n_tokens, over_limit``, a row for each row of ``documents``.

    ``documents``: ``doc_id`` and ``text``; other columns are ignored.  A NULL
    text is empty (0 bytes, 0 tokens); a NULL or repeated id keeps its own row.
    ``path``: a tokenizers file.  The input must come in the same order when a
    lost task is run again, as a scan of files does.
    """
    path = path or tokenizer_path()
    at_hand(documents.sparkSession)
    spark = documents.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bound = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(
        _bind(path, BUCKETS * n), _SHEAF
    )
    sums = bound.repartition(n, "part").mapInArrow(_count(path), _SHEAF)
    return (
        sums.groupBy("sheaf")
        .applyInArrow(_unbind, "doc_id long, n_bytes long, n_tokens long")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
