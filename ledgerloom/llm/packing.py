"""Packing of documents into sequences by linear grouping.

Documents become pieces of at most ``size`` tokens.  How many pieces of each
length there are is a table of ``size`` numbers, whatever the number of documents,
and the whole packing is planned on it:

1. Large pieces are put in order of length and dealt into groups of equal number;
   every piece counts as long as the longest of its group.
2. For these few sizes the configurations (what one sequence holds) that need the
   fewest sequences come from the linear program over all of them, by column
   generation; its solution is rounded down.
3. Actual pieces take the places of their group, the longest first.
4. Small pieces, and the large ones that rounding left over, go best-fit into what
   is left, the longest first, and into new sequences when nothing fits.

The plan says of every length which ranks go to which sequences, in ranges, so it
stays small.  Pieces are numbered within their length by the task that wrote them
and by sums over tasks, and look their place up.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import at_hand, slices, spans, stored, texts_of
from ledgerloom.llm.tokenizing import encode_texts, tokenizer_path

SIZE = 2048
END_ID = 0
#: Ways that are planned: a piece longer than ``size // n`` is large, with so many groups.  The plan with the fewest
#: sequences is taken: with many small pieces few should be large, with none many.
WAYS = ((2, 256), (3, 256), (4, 96), (8, 48))


# --- the plan -------------------------------------------------------------------------------------------------------


def grouped(lengths: np.ndarray, counts: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and numbers of pieces of the groups; ``lengths`` falls.  Groups of one size are one."""
    ends = np.cumsum(counts)
    width = -(-int(ends[-1]) // groups)
    first = np.arange(0, int(ends[-1]), width)
    sizes = lengths[np.searchsorted(ends, first, side="right")]
    numbers = np.diff(np.append(first, ends[-1]))
    new = np.flatnonzero(np.r_[True, sizes[1:] != sizes[:-1]])
    return sizes[new], np.add.reduceat(numbers, new)


def best_configuration(sizes: np.ndarray, values: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """The pieces worth most that fit into one sequence."""
    worth = np.zeros(size + 1)
    used = np.zeros((len(sizes), size + 1), np.int16)
    for i, (s, v) in enumerate(zip(sizes.tolist(), values.tolist(), strict=True)):
        if v <= 1e-12:
            continue
        before = worth.copy()
        for k in range(1, size // s + 1):
            more = before[: size + 1 - k * s] + k * v
            better = more > worth[k * s :] + 1e-12
            worth[k * s :][better] = more[better]
            used[i, k * s :][better] = k
    out, room = np.zeros(len(sizes), np.int64), size
    for i in range(len(sizes) - 1, -1, -1):
        out[i] = used[i, room]
        room -= int(out[i]) * int(sizes[i])
    return float(worth[size]), out


def configurations(sizes: np.ndarray, numbers: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Configurations (a column each) and how often each is used in the least fractional packing, rounded down.

    No configuration is left out: one enters as long as any would lower the number of sequences.  Every step is a
    packing, so an end of the steps (a hundred per size; some are enough) would only cost sequences.
    """
    basis = np.diag(size // sizes).astype(float)
    need = numbers.astype(float)
    for _ in range(100 * len(sizes)):
        amount = np.linalg.solve(basis, need)
        values = np.linalg.solve(basis.T, np.ones(len(sizes)))
        worth, column = best_configuration(sizes, values, size)
        if worth <= 1 + 1e-7:
            break
        step = np.linalg.solve(basis, column.astype(float))
        can = step > 1e-9
        ratio = np.where(can, np.maximum(amount, 0) / np.where(can, step, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = column
    amount = np.linalg.solve(basis, need)
    return basis.astype(np.int64), np.floor(np.maximum(amount, 0) + 1e-6).astype(np.int64)


class _Plan:
    """Ranges of ranks of a length, the sequences they go to, one each, and where there they begin."""

    def __init__(self):
        self.rows: list[tuple[int, int, int, int, int]] = []

    def put(self, length: int, rank: int, count: int, sequence: int, offset: int) -> None:
        if count:
            self.rows.append((length, rank, count, sequence, offset))

    def table(self) -> np.ndarray:
        rows = np.array(self.rows, np.int64).reshape(-1, 5)
        return rows[np.lexsort((rows[:, 1], rows[:, 0]))]


def plan(counts: np.ndarray, size: int = SIZE, ways: tuple[tuple[int, int], ...] = WAYS) -> np.ndarray:
    """Rows (length, first rank, number of ranks, first sequence, offset) for ``counts[length]`` pieces of each length."""
    plans = [_planned(np.asarray(counts, np.int64), size, small, groups) for small, groups in ways]
    return min(plans, key=lambda rows: int((rows[:, 2] + rows[:, 3]).max(initial=0)))


def _planned(counts: np.ndarray, size: int, small: int, groups: int) -> np.ndarray:
    out = _Plan()
    open_at: dict[int, list[tuple[int, int]]] = {}
    sequences = 0
    large = np.flatnonzero(counts)[::-1]
    large = large[large > size // small]
    if len(large):
        ends = np.cumsum(counts[large])
        starts = ends - counts[large]
        sizes, numbers = grouped(large, counts[large], groups)
        columns, times = configurations(sizes, numbers, size)
        # The next piece of every group, in the order of all large pieces.
        cursor = spans(numbers)[:-1]
        limit = spans(numbers)[1:]
        for column, n in zip(columns.T, times.tolist(), strict=True):
            some = column > 0
            n = min(n, int(((limit - cursor)[some] // column[some]).min()))
            if not n:
                continue
            places = [i for i in np.flatnonzero(column).tolist() for _ in range(int(column[i]))]
            begin = []
            for i in places:
                begin.append(int(cursor[i]))
                cursor[i] += n
            # Stretches of sequences in which every place has one length.
            cuts = {0, n}
            for b in begin:
                k = np.searchsorted(ends, [b, b + n])
                cuts.update(int(x) - b for x in ends[k[0] : k[1]] if b < x < b + n)
            cuts = sorted(cuts)
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                offset = 0
                for b in begin:
                    k = int(np.searchsorted(ends, b + lo, side="right"))
                    length = int(large[k])
                    out.put(length, b + lo - int(starts[k]), hi - lo, sequences + lo, offset)
                    offset += length
                open_at.setdefault(size - offset, []).append((sequences + lo, hi - lo))
            sequences += n
        # What rounding left over, as ranges of ranks of its lengths.
        left = [(int(a), int(b)) for a, b in zip(cursor, limit, strict=True) if a < b]
    else:
        left = []
    waiting: list[tuple[int, int, int]] = []
    for a, b in left:
        k = int(np.searchsorted(ends, a, side="right"))
        while a < b:
            to = min(b, int(ends[k]))
            waiting.append((int(large[k]), a - int(starts[k]), to - a))
            a, k = to, k + 1
    waiting += [(int(x), 0, int(counts[x])) for x in np.flatnonzero(counts)[::-1] if x <= size // small]
    rooms = sorted(r for r in open_at if r)
    for length, rank, count in sorted(waiting, reverse=True):
        while count:
            k = bisect_left(rooms, length)
            if k == len(rooms):
                per = size // length
                n = -(-count // per)
                open_at[size] = [(sequences, n)]
                rooms.append(size)
                sequences += n
            room = rooms[k]
            per = room // length
            first, n = open_at[room].pop()
            whole = min(n, count // per)
            if whole:
                for j in range(per):
                    out.put(length, rank + j * whole, whole, first, size - room + j * length)
                rank, count, used, rest = rank + per * whole, count - per * whole, whole, room - per * length
            else:
                for j in range(count):
                    out.put(length, rank + j, 1, first, size - room + j * length)
                used, rest, count = 1, room - count * length, 0
            if n > used:
                open_at[room].append((first + used, n - used))
            if not open_at[room]:
                del open_at[room]
                rooms.pop(k)
            if rest:
                if rest not in open_at:
                    open_at[rest] = []
                    insort(rooms, rest)
                open_at[rest].append((first, used))
    return out.table()


# --- the documents --------------------------------------------------------------------------------------------------

_KEY = 40


def _cut(path: str, end_id: int, size: int, with_ids: bool):
    """Documents to pieces, numbered by length within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in batches:
            for some in slices(batch, rows=4096):
                own, counts = encode_texts(path, texts_of(some))
                ids = np.insert(own, np.cumsum(counts), end_id).astype("<u4")
                counts = counts + 1
                parts = -(-counts // size)
                doc = np.repeat(np.arange(len(counts)), parts)
                piece = np.arange(len(doc)) - np.repeat(spans(parts)[:-1], parts)
                first = (counts - (parts - 1) * size)[doc]
                length = np.where(piece == 0, first, size)
                start = np.where(piece == 0, 0, first + (piece - 1) * size)
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                nth = np.empty(len(doc), np.int64)
                nth[order] = np.arange(len(doc)) - np.searchsorted(ordered, ordered)
                nth += seen[length]
                seen += np.bincount(length, minlength=size + 1)
                at = spans(counts)[:-1][doc] + start
                ends = zip(at.tolist(), (at + length).tolist(), strict=True)
                columns = [
                    some.column(0).take(pa.array(doc)),
                    pa.array(piece, pa.int32()),
                    pa.array(start),
                    pa.array(length),
                    pa.array([zlib.crc32(ids[a:b]) for a, b in ends], pa.int64()),
                    pa.array(np.full(len(doc), block)),
                    pa.array(nth),
                ]
                if with_ids:
                    # The pieces of a document follow one another, as its ids do.
                    columns.append(pa.ListArray.from_arrays(pa.array(spans(length), pa.int32()), pa.array(ids.view("<i4"))))
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "block", "nth", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

    return run


def _placed(shared):
    """Rank within the length to sequence and offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shared.value
        keys = (rows[:, 0] << _KEY) | rows[:, 1]
        for batch in batches:
            rank = batch.column(0).to_numpy()
            at = np.searchsorted(keys, (batch.column("length").to_numpy() << _KEY) | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(rows[at, 3] + rank - rows[at, 1]), pa.array(rows[at, 4])],
                names=[*batch.schema.names[1:], "sequence_id", "offset"],
            )

    return run


def pack(
    documents: DataFrame, path: str | None = None, size: int = SIZE, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Every document in sequences of at most ``size`` tokens: a row per piece.

    ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, and ``ids`` if asked
    for.  A document is its ids and ``end_id``.  One longer than ``size`` is cut into pieces
    of ``size`` tokens, of which the first may be shorter; ``start`` counts its ids before
    the piece, ``offset`` the tokens before the piece in its sequence, without gaps.

    ``documents``: ``doc_id`` and ``text``; other columns are ignored.  A NULL text is empty
    and leaves its end id alone.  NULL and repeated ids and repeated rows are packed as rows
    of their own.  An empty table gives no pieces.  The pieces are written once to the shared
    scratch folder; what the driver holds is the number of pieces of each length and the plan.
    """
    spark = documents.sparkSession
    at_hand(spark)
    path = path or tokenizer_path("byte_bpe_50k.json")
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long, block long, nth long"
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    cut = rows.mapInArrow(_cut(path, end_id, size, with_ids), fields + ", ids array<int>" * with_ids)
    pieces = stored(cut, "pieces")
    by_block = pieces.groupBy("length", "block").agg(F.count("*").alias("n"))
    counts = np.zeros(size + 1, np.int64)
    # At most ``size`` rows.
    for length, n in by_block.groupBy("length").agg(F.sum("n")).collect():
        counts[length] = n
    shared = spark.sparkContext.broadcast(plan(counts, size))
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_block.select("length", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "block"]).select(
        (F.col("base") + F.col("nth")).alias("rank"), *pieces.drop("block", "nth").columns
    )
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema.fields[1:])
    return ranked.mapInArrow(_placed(shared), f"{out}, sequence_id long, offset long")


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids`` of the pieces that ``pack`` gives with ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids")
    )
