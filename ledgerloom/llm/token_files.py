"""Token ids in grammar-compressed files.

The ids of consecutive documents form a block.  Re-Pair replaces frequent pairs
of neighbouring symbols by nonterminals until no pair has ``LEAST`` occurrences.  Each round
replaces all pairs of so many occurrences at once, the more frequent
first where two overlap, as replacing them one by one would rescan the block for
every rule.

File format: Parquet, one row per block:

===============  ==========================================================
``block``        number, ascending with the ids of the documents
``terminals``    ids below this number stand for themselves
``rules``        little-endian uint32 pairs; rule r is symbol terminals + r
``expansions``   little-endian uint32: how many ids each nonterminal stands for
``symbols``      little-endian uint32: the compressed block
``doc_id``       the documents in order
``first_symbol`` where each document's symbols start
``skip``         ids of that symbol which belong to earlier documents
``n_tokens``     ids of each document, with its end id
===============  ==========================================================

``decode_document`` expands the symbols of one document alone, as the expansion
lengths tell how far a symbol reaches.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import at_hand, gather, order_of, slices, spans, texts_of
from ledgerloom.llm.tokenizing import encode_texts, pre_tokenizer, tokenizer_path
from ledgerloom.session import scratch_path

END_ID = 1
#: A pair becomes a rule from so many occurrences on: the rule and its expansion length take three numbers.
LEAST = 16
SCHEMA = (
    "block long, terminals long, rules binary, expansions binary, symbols binary, "
    "doc_id array<long>, first_symbol array<long>, skip array<long>, n_tokens array<long>"
)
_BITS = 18


def _frequent(seq: np.ndarray, least: int, fresh: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of neighbours with at least so many occurrences, the most frequent first; where they stand; which there.

    Only pairs with a symbol from ``fresh`` on: the others were seen in the round before and are too few.
    """
    at = np.flatnonzero((seq[:-1] >= fresh) | (seq[1:] >= fresh))
    key = (seq[at] << 32) | seq[at + 1]
    # Numbers of hashed pairs bound the exact ones, so only the pairs of full cells are sorted.
    cell = (key * np.int64(-7046029254386353131)).view(np.uint64) >> np.uint64(64 - _BITS)
    cell = cell.view(np.int64)
    full = np.flatnonzero((np.bincount(cell, minlength=1 << _BITS) >= least)[cell])
    if not len(full):
        return full, full, full
    order = full[order_of(seq[at[full]], seq[at[full] + 1])]
    ordered = key[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    counts = np.diff(np.r_[starts, len(ordered)])
    keep = np.flatnonzero(counts >= least)
    keep = keep[np.argsort(-counts[keep], kind="stable")]
    number = np.full(len(starts), -1, np.int32)
    number[keep] = np.arange(len(keep))
    rank = np.full(len(at), -1, np.int32)
    rank[order] = np.repeat(number, counts)
    where = np.flatnonzero(rank >= 0)
    return ordered[starts[keep]], at[where], rank[where]


def _replace(seq: np.ndarray, where: np.ndarray, rank: np.ndarray, first: int) -> np.ndarray:
    """Replace the pairs that start at ``where``; of two that overlap the better rank wins, or the earlier."""
    taken = np.zeros(len(seq) + 1, bool)
    out = seq.copy()
    while len(where):
        # An occurrence is taken if no overlapping one has a better rank, or the same and stands before it.
        beside = where[1:] == where[:-1] + 1
        before = np.r_[False, beside & (rank[:-1] <= rank[1:])]
        after = np.r_[beside & (rank[1:] < rank[:-1]), False]
        win = ~before & ~after
        now = where[win]
        out[now] = first + rank[win]
        out[now + 1] = -1
        taken[now] = taken[now + 1] = True
        left = ~(taken[where] | taken[where + 1])
        where, rank = where[left], rank[left]
    return out[out >= 0]


def repair(
    ids: np.ndarray, terminals: int, least: int = LEAST
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, rules (n x 2) and expansion lengths of a run of ids."""
    seq = ids.astype(np.int64)
    rules: list[np.ndarray] = []
    lengths = np.ones(0, np.int64)
    first, fresh = terminals, 0
    while len(seq) > 1:
        keys, where, rank = _frequent(seq, least, fresh)
        if not len(keys):
            break
        fresh = first
        seq = _replace(seq, where, rank, first)
        pairs = np.stack([keys >> 32, keys & 0xFFFFFFFF], 1)
        size = np.where(pairs < terminals, 1, 0)
        if len(lengths):
            size = np.where(pairs < terminals, 1, lengths[np.clip(pairs - terminals, 0, len(lengths) - 1)])
        lengths = np.concatenate([lengths, size.sum(1)])
        rules.append(pairs)
        first += len(keys)
    return seq, np.concatenate(rules) if rules else np.zeros((0, 2), np.int64), lengths


def expand(symbols: np.ndarray, rules: np.ndarray, terminals: int) -> np.ndarray:
    """The ids that symbols stand for."""
    out = symbols.astype(np.int64)
    while len(out):
        inner = out >= terminals
        if not inner.any():
            break
        width = inner + 1
        start = np.cumsum(width) - width
        wide = np.empty(int(width.sum()), np.int64)
        wide[start] = np.where(inner, 0, out)
        pair = rules[out[inner] - terminals]
        wide[start[inner]], wide[start[inner] + 1] = pair[:, 0], pair[:, 1]
        out = wide
    return out


def _sizes(symbols: np.ndarray, expansions: np.ndarray, terminals: int) -> np.ndarray:
    size = np.ones(len(symbols), np.int64)
    inner = symbols >= terminals
    size[inner] = expansions[symbols[inner] - terminals]
    return size


def _u32(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values, "<u4").tobytes()


def block_row(ids: np.ndarray, lengths: np.ndarray, doc_ids: list, block: int, terminals: int) -> dict:
    symbols, rules, expansions = repair(ids, terminals)
    reach = np.cumsum(_sizes(symbols, expansions, terminals))
    starts = np.cumsum(lengths) - lengths
    first = np.searchsorted(reach, starts, side="right")
    before = np.where(first > 0, reach[first - 1], 0) if len(reach) else starts
    return {
        "block": block,
        "terminals": terminals,
        "rules": _u32(rules.ravel()),
        "expansions": _u32(expansions),
        "symbols": _u32(symbols),
        "doc_id": doc_ids,
        "first_symbol": first.tolist(),
        "skip": (starts - before).tolist(),
        "n_tokens": lengths.tolist(),
    }


class Grammar:
    """A block's rules, each expanded once."""

    def __init__(self, row: dict):
        self.terminals = row["terminals"]
        self.sizes = np.frombuffer(row["expansions"], "<u4").astype(np.int64)
        self.flat = expand(np.frombuffer(row["rules"], "<u4"), self._pairs(row), self.terminals)
        self.starts = spans(self.sizes)[:-1]

    @staticmethod
    def _pairs(row: dict) -> np.ndarray:
        return np.frombuffer(row["rules"], "<u4").reshape(-1, 2).astype(np.int64)

    def ids(self, symbols: np.ndarray) -> np.ndarray:
        inner = symbols >= self.terminals
        sizes = _sizes(symbols, self.sizes, self.terminals)
        out = np.repeat(symbols, sizes).astype(np.int64)
        rule = symbols[inner] - self.terminals
        out[np.repeat(inner, sizes)] = gather(self.flat, self.starts[rule], self.sizes[rule])
        return out


def decode_block(row: dict) -> np.ndarray:
    """All ids of a block."""
    return Grammar(row).ids(np.frombuffer(row["symbols"], "<u4").astype(np.int64))


def decode_document(row: dict, i: int) -> np.ndarray:
    """The ids of the i-th document of a block; only its own symbols are expanded."""
    rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2).astype(np.int64)
    symbols = np.frombuffer(row["symbols"], "<u4").astype(np.int64)
    expansions = np.frombuffer(row["expansions"], "<u4").astype(np.int64)
    first, skip, n = row["first_symbol"][i], row["skip"][i], row["n_tokens"][i]
    last, reached = first, 0
    while reached < skip + n:
        step = symbols[last : last + 4096]
        ends = reached + np.cumsum(_sizes(step, expansions, row["terminals"]))
        use = int(np.searchsorted(ends, skip + n)) + 1
        last, reached = last + min(use, len(step)), int(ends[min(use, len(step)) - 1])
    return expand(symbols[first:last], rules, row["terminals"])[skip : skip + n]


_OUT = pa.schema(
    [
        ("block", pa.int64()),
        ("terminals", pa.int64()),
        ("rules", pa.binary()),
        ("expansions", pa.binary()),
        ("symbols", pa.binary()),
        ("doc_id", pa.list_(pa.int64())),
        ("first_symbol", pa.list_(pa.int64())),
        ("skip", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())),
    ]
)


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = pre_tokenizer(path)
        terminals = max(tok.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in slices(batch, rows=4096):
                runs, lengths = encode_texts(path, texts_of(piece))
                ids = np.insert(runs, np.cumsum(lengths), end_id)
                lengths = lengths + 1
                docs = piece.column(piece.schema.get_field_index("doc_id")).to_pylist()
                row = block_row(ids, lengths, docs, (task << 32) + number, terminals)
                number += 1
                yield pa.RecordBatch.from_pylist([row], schema=_OUT)

    return run


def write_token_files(
    documents: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID
) -> None:
    """Encode every whole text and write grammar-compressed blocks in ascending ``doc_id`` order.

    ``documents``: ``doc_id`` and ``text``; other columns are ignored.  NULL ids
    come first, rows of one id in the order of their texts; a NULL text is empty
    and leaves its end id alone.  An empty table leaves a folder without blocks.
    """
    path = path or tokenizer_path()
    at_hand(documents.sparkSession)
    n = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .repartitionByRange(n, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(_encode(path, end_id), SCHEMA)
        .write.parquet(folder)
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = decode_block(row).astype("<u4")
            ends = np.cumsum(row["n_tokens"])
            starts = ends - row["n_tokens"]
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([row["block"]] * len(ends), pa.int64()),
                    "doc_id": pa.array(row["doc_id"], pa.int64()),
                    "start": pa.array(starts, pa.int64()),
                    "n_tokens": pa.array(row["n_tokens"], pa.int64()),
                    "ids_crc32": pa.array(
                        [zlib.crc32(ids[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)], pa.int64()
                    ),
                }
            )


def read_token_files(spark, folder: str) -> DataFrame:
    """Per document: ``doc_id, start, n_tokens, ids_crc32`` from the files alone; start counts over all blocks."""
    blocks = spark.read.schema(SCHEMA).parquet(folder)
    # One row per block of some megabytes of text.
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.select("block", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    offsets = sizes.select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    digests = blocks.mapInArrow(_digests, "block long, doc_id long, start long, n_tokens long, ids_crc32 long")
    return digests.join(offsets, "block").select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(documents: DataFrame, path: str | None = None, folder: str | None = None) -> DataFrame:
    """Write the files to a new shared folder and read them back."""
    folder = folder or scratch_path(documents.sparkSession, "token-files")
    write_token_files(documents, folder, path)
    return read_token_files(documents.sparkSession, folder)
