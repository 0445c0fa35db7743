"""Phrases whose words keep together, from suffix subtrees of bounded size.

Every word of a text begins a suffix, cut off after ``DEPTH`` words and at the end
of its piece.  The suffixes of a language would make one large tree, so it is
partitioned vertically: prefixes are counted first, one of more than ``budget``
suffixes is made longer by a word, and the others are grouped until a group has
``budget`` suffixes.  Each group goes to one task, which builds its subtree alone:
its suffixes in order are the leaves, a node is a stretch of them with the same
first words, and the total of its leaves is the number of its phrase.

Map tasks count equal suffixes before they leave, so a frequent phrase travels once
per slice of text.  Prefixes are assigned to groups by a hash: the tasks get an
array of hash cells and the few prefixes over the budget, both of a size that
follows the number of groups, never the words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import at_hand, gather, order_of, slices, spans, stored, texts_of

#: Words of the longest phrase.
DEPTH = 4
#: Suffixes of one group.
BUDGET = 1 << 21
#: Hash cells per group.
CELLS = 16
LEAST = 30
#: Bytes of text that a task holds at once, to count words and to gather suffixes.
_SIZE, _SIZE_SUFFIXES = 8 << 20, 4 << 20
_KIND = np.full(256, 2, np.uint8)
_KIND[[0x20, 0x09]] = 0
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 1
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


# --- inside the tasks -----------------------------------------------------------------------------------------------


def _strings(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(spans(lengths)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), buffers)


class _Words:
    """The words of a slice of texts."""

    def __init__(self, batch: pa.RecordBatch):
        texts = texts_of(batch)
        data = np.frombuffer(b"\n".join([*texts, b"\n"]).translate(_LOWER), np.uint8)
        kind = _KIND[data]
        keep = kind == 2
        start = keep & ~np.r_[False, keep[:-1]]
        at = np.flatnonzero(start)
        begin = np.flatnonzero(start[keep])
        found = _strings(data[keep], np.diff(np.append(begin, int(keep.sum())))).dictionary_encode()
        #: Different words, and the number of each word.
        self.names = found.dictionary
        self.code = found.indices.to_numpy().astype(np.int64)
        self.piece = np.cumsum(kind == 1)[at]
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        per_text = np.diff(np.r_[0, np.searchsorted(at, ends)])
        lang = batch.column(batch.schema.get_field_index("lang")).dictionary_encode()
        self.langs = lang.dictionary.to_pylist()
        self.lang = np.repeat(lang.indices.to_numpy().astype(np.int64), per_text)

    def next(self, k: int) -> np.ndarray:
        """The word k places further, counted from 1; 0 beyond the end of the piece."""
        out = np.zeros(len(self.code), np.int64)
        if k < len(out):
            out[: len(out) - k] = np.where(self.piece[k:] == self.piece[: len(out) - k], self.code[k:] + 1, 0)
        return out


def _counted(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each pair among the different ones, in their order; where each first stands; how often."""
    order = order_of(high, low)
    a, b = high[order], low[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
    number = np.empty(len(a), np.int64)
    number[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return number, order[first], np.diff(np.append(first, len(a)))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some in slices(batch, rows=1 << 16, size=_SIZE):
            words = _Words(some)
            _, first, n = _counted(words.lang, words.code)
            lang, code = words.lang[first], words.code[first]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(words.langs, pa.string()).take(pa.array(lang)),
                    words.names.take(pa.array(code)).cast(pa.binary()).cast(pa.string()),
                    pa.array(n),
                ],
                names=["lang", "phrase", "n"],
            )


class _Suffixes:
    """Different suffixes of two words and more of a slice, how often each is there, and their prefixes."""

    def __init__(self, words: _Words, heavy: dict[tuple[str, bytes], int]):
        use = np.flatnonzero(words.next(1))
        keys = [words.code[use] + 1, *(words.next(k)[use] for k in range(1, DEPTH))]
        lang = words.lang[use]
        top = len(words.names) + 1
        head, _, _ = _counted(lang * top + keys[0], keys[1])
        tail, _, _ = _counted(keys[2], keys[3])
        _, first, self.n = _counted(head, tail)
        self.words, self.lang = words, lang[first]
        self.keys = np.stack([k[first] for k in keys])
        self.depth = np.ones(len(first), np.int64)
        self.hash = np.zeros(len(first), np.int64)
        self.names = words.names.to_pylist()
        seeds = [zlib.crc32(x.encode() + b"\0") for x in words.langs]
        # The prefix is the first word, and one over the budget is followed by its next word.
        key = self.lang * top + self.keys[0]
        known = np.unique(key)
        names, langs = [self.names[k - 1] for k in (known % top).tolist()], (known // top).tolist()
        crc = [zlib.crc32(x, seeds[i]) for i, x in zip(langs, names, strict=True)]
        number = np.searchsorted(known, key)
        self.hash = np.array(crc, np.int64)[number]
        over = np.array([(words.langs[i], x) in heavy for i, x in zip(langs, names, strict=True)], bool)
        rows = np.flatnonzero(over[number]) if heavy else np.zeros(0, np.int64)
        number = key[rows]
        for depth in range(2, DEPTH + 1):
            if not len(rows):
                break
            # Also those that end here: their prefix is no node of one group.
            self.depth[rows] = depth
            longer = self.keys[depth - 1, rows] > 0
            rows, number = rows[longer], number[longer]
            number, place, _ = _counted(number, self.keys[depth - 1, rows])
            texts = [(int(self.lang[r]), self.text(r, depth)) for r in rows[place].tolist()]
            self.hash[rows] = np.array([zlib.crc32(t, seeds[i]) for i, t in texts], np.int64)[number]
            over = np.array([(words.langs[i], t) in heavy for i, t in texts], bool)[number]
            rows, number = rows[over], number[over]

    def text(self, row: int, depth: int) -> bytes:
        return b" ".join([self.names[k - 1] for k in self.keys[:depth, row].tolist() if k])


def _longer(heavy: dict[tuple[str, bytes], int], depth: int):
    """Numbers of the prefixes of ``depth`` words that begin with one over the budget."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, rows=1 << 16, size=_SIZE_SUFFIXES):
                found = _Suffixes(_Words(some), heavy)
                rows = np.flatnonzero((found.depth == depth) & (found.keys[depth - 1] > 0))
                total: dict[tuple[int, bytes], int] = {}
                for r, n in zip(rows.tolist(), found.n[rows].tolist(), strict=True):
                    key = (int(found.lang[r]), found.text(r, depth))
                    total[key] = total.get(key, 0) + n
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([found.words.langs[i] for i, _ in total], pa.string()),
                        pa.array([t.decode() for _, t in total], pa.string()),
                        pa.array(list(total.values()), pa.int64()),
                    ],
                    names=["lang", "phrase", "n"],
                )

    return run


_PART = pa.schema(
    [
        ("group", pa.int32()),
        ("lang", pa.string()),
        ("depth", pa.int32()),
        ("n_suffixes", pa.int32()),
        ("n_words", pa.int32()),
        ("n_bytes", pa.int32()),
        ("suffixes", pa.binary()),
        ("sizes", pa.binary()),
        ("words", pa.binary()),
    ]
)
_PART_SQL = (
    "group int, lang string, depth int, n_suffixes int, n_words int, n_bytes int, "
    "suffixes binary, sizes binary, words binary"
)


def _dealt(shared):
    """Suffixes by group, language and length of prefix: a row for all of a slice, with the words they use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group_of, heavy = shared.value
        for batch in batches:
            for some in slices(batch, rows=1 << 16, size=_SIZE_SUFFIXES):
                words = _Words(some)
                found = _Suffixes(words, heavy)
                group = group_of[found.hash % len(group_of)]
                order = order_of(group, found.lang * (DEPTH + 1) + found.depth)
                key = (group * len(words.langs) + found.lang) * (DEPTH + 1) + found.depth
                key = key[order]
                cuts = np.append(np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), len(key)) if len(key) else [0]
                sizes = pa.compute.binary_length(words.names).to_numpy().astype(np.int64)
                place = np.zeros(len(sizes) + 1, np.int64)
                letters, begins = np.frombuffer(b"".join(found.names), np.uint8), spans(sizes)[:-1]
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    rows = order[a:b]
                    keys = found.keys[:, rows]
                    own = np.unique(keys)
                    own = own[own > 0] - 1
                    place[own + 1] = np.arange(1, len(own) + 1)
                    text = gather(letters, begins[own], sizes[own])
                    body = np.concatenate([place[keys].ravel(), found.n[rows]]).astype("<i4")
                    r = int(rows[0])
                    yield pa.RecordBatch.from_pylist(
                        [
                            {
                                "group": int(group[r]),
                                "lang": words.langs[found.lang[r]],
                                "depth": int(found.depth[r]),
                                "n_suffixes": len(rows),
                                "n_words": len(own),
                                "n_bytes": len(text),
                                "suffixes": pa.compress(body, "zstd", asbytes=True),
                                "sizes": pa.compress(sizes[own].astype("<i4"), "zstd", asbytes=True),
                                "words": pa.compress(text, "zstd", asbytes=True),
                            }
                        ],
                        schema=_PART,
                    )

    return run


def subtree(keys: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Depth, nodes (a column each) and totals of the tree whose leaves are the columns of ``keys``, 0 after their end."""
    head, _, _ = _counted(keys[0], keys[1])
    tail, _, _ = _counted(keys[2], keys[3])
    order = order_of(head, tail)
    keys, n = keys[:, order], n[order]
    new = np.zeros(keys.shape[1], bool)
    new[:1] = True
    for depth in range(1, DEPTH + 1):
        new[1:] |= keys[depth - 1, 1:] != keys[depth - 1, :-1]
        first = np.flatnonzero(new)
        total = np.add.reduceat(n, first) if len(first) else n
        real = keys[depth - 1, first] > 0
        yield depth, keys[:depth, first[real]], total[real]


def _phrases(least: int):
    def run(group: pa.Table) -> pa.Table:
        out: dict[str, list] = {"lang": [], "phrase": [], "n": []}
        kinds = group.group_by(["lang", "depth"]).aggregate([]).to_pylist()
        for kind in kinds:
            own = group.filter(
                (pa.compute.field("lang") == kind["lang"]) & (pa.compute.field("depth") == kind["depth"])
            ).to_pylist()
            sizes = [
                np.frombuffer(pa.decompress(r["sizes"], 4 * r["n_words"], "zstd"), "<i4").astype(np.int64) for r in own
            ]
            text = b"".join([pa.decompress(r["words"], r["n_bytes"], "zstd", asbytes=True) for r in own])
            found = _strings(np.frombuffer(text, np.uint8), np.concatenate(sizes)).dictionary_encode()
            code = np.r_[0, found.indices.to_numpy().astype(np.int64) + 1]
            begin = spans(np.array([len(s) for s in sizes]))
            keys, n = [], []
            for r, b in zip(own, begin.tolist(), strict=False):
                m = r["n_suffixes"]
                body = np.frombuffer(pa.decompress(r["suffixes"], 4 * (DEPTH + 1) * m, "zstd"), "<i4").astype(np.int64)
                place = body[: DEPTH * m].reshape(DEPTH, m)
                keys.append(code[np.where(place > 0, place + b, 0)])
                n.append(body[DEPTH * m :])
            del own, text
            names = found.dictionary.to_pylist()
            for depth, nodes, total in subtree(np.concatenate(keys, axis=1), np.concatenate(n)):
                if depth < max(2, kind["depth"]):
                    continue
                for k in np.flatnonzero(total >= least).tolist():
                    out["lang"].append(kind["lang"])
                    out["phrase"].append(b" ".join([names[w - 1] for w in nodes[:, k].tolist()]).decode())
                    out["n"].append(int(total[k]))
        return pa.table(
            {"lang": pa.array(out["lang"], pa.string()), "phrase": pa.array(out["phrase"], pa.string()), "n": pa.array(out["n"], pa.int64())}
        )

    return run


# --- the jobs -------------------------------------------------------------------------------------------------------


def phrase_counts(documents: DataFrame, least: int = LEAST, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, n`` of all phrases of one to four words with at least so many occurrences, and ``lang, n`` of all words.

    ``documents``: ``text`` and ``lang``; see ``collocations``.
    """
    spark = documents.sparkSession
    at_hand(spark)
    docs = documents.select(
        F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    )
    fields = "lang string, phrase string, n long"
    words = stored(
        docs.mapInArrow(_word_counts, fields).groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "words"
    )
    total = words.agg(F.sum("n")).first()[0] or 0
    n_cells = CELLS * max(1, -(-total // budget))
    cell = F.pmod(F.crc32(F.concat_ws("\0", "lang", "phrase").cast("binary")), F.lit(n_cells)).alias("cell")
    cells = np.zeros(n_cells, np.int64)
    heavy: dict[tuple[str, bytes], int] = {}
    prefixes, known = words, []
    for depth in range(1, DEPTH + 1):
        # As many rows as cells, and fewer prefixes over the budget than groups.
        light = prefixes.where(F.col("n") <= budget) if depth < DEPTH else prefixes
        for c, n in light.groupBy(cell).agg(F.sum("n")).collect():
            cells[c] += n
        over = prefixes.where(F.col("n") > budget).collect() if depth < DEPTH else []
        if not over:
            break
        heavy |= {(r.lang, r.phrase.encode()): r.n for r in over}
        longer = docs.mapInArrow(_longer(dict(heavy), depth + 1), fields)
        prefixes = stored(longer.groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "prefixes")
        known.append(prefixes.where((F.col("n") > budget) & (F.col("n") >= least)))
    group_of, group, held = np.zeros(n_cells, np.int64), 0, 0
    for c, n in enumerate(cells.tolist()):
        if held and held + n > budget:
            group, held = group + 1, 0
        group_of[c], held = group, held + n
    shared = spark.sparkContext.broadcast((group_of, heavy))
    dealt = docs.mapInArrow(_dealt(shared), _PART_SQL)
    found = dealt.groupBy("group").applyInArrow(_phrases(least), fields)
    # Phrases over the budget are no nodes of one group; those of all ``DEPTH`` words are.
    for table in known[: DEPTH - 2]:
        found = found.unionAll(table)
    counts = stored(found.unionAll(words.where(F.col("n") >= least)), "phrases")
    return counts, words.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(
    documents: DataFrame, top: int = 2000, least: int = LEAST, budget: int = BUDGET, covered: int = 80
) -> DataFrame:
    """The best phrases of every language: ``lang, rank, phrase, a, l, r, n, score``.

    A-Z are lower-cased, texts split into pieces at ``.,;:!?`` and line ends, pieces
    into words at blanks and tabs.  A phrase of two to four words that stands ``a`` (at
    least ``least``) times in pieces of the language is a candidate.  Its score is
    2 000 000 * a / (l + r), rounded down, for the cut into a first part of l and a
    rest of r occurrences that gives the least (the earliest of several).  A phrase
    is left out if a longer candidate that holds its words one after another stands
    at least ``covered`` percent as often.  ``n``: words of the language.  Each language
    has its first ``top`` phrases by score and ``a``, both falling, and phrase (by bytes).

    ``documents``: ``text`` and ``lang``; other columns are ignored.  NULL languages are
    ``und``; NULL and empty texts have no words; repeated rows count again; without a
    candidate, as with an empty table, there are no rows.
    """
    counts, words = phrase_counts(documents, least, budget)
    some = counts.withColumn("words", F.split("phrase", " ", -1)).withColumn("k", F.size("words"))
    candidates = some.where("k > 1")
    cut = "transform(sequence(1, k - 1), c -> struct(c AS cut, concat_ws(' ', slice(words, 1, c)) AS left, concat_ws(' ', slice(words, c + 1, k - c)) AS right))"
    cuts = candidates.select("lang", "phrase", F.col("n").alias("a"), F.expr(f"inline({cut})"))
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    score = F.expr("CAST(a AS DECIMAL(20, 0)) * 2000000 div (CAST(l AS DECIMAL(20, 0)) + r)")
    scored = (
        cuts.join(left, ["lang", "left"])
        .join(right, ["lang", "right"])
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("least"))
        .select("lang", "phrase", "a", "least.l", "least.r", "least.score")
    )
    inner = """flatten(transform(sequence(2, k - 1), m ->
        transform(sequence(1, k - m + 1), i -> concat_ws(' ', slice(words, i, m)))))"""
    within = (
        candidates.where("k > 2")
        .select("lang", F.expr(f"explode({inner})").alias("phrase"), "n")
        .groupBy("lang", "phrase")
        .agg(F.max("n").alias("longer"))
    )
    # Multiplied as decimals: the products may pass 64 bits.
    kept = (
        scored.join(within, ["lang", "phrase"], "left")
        .where(F.expr(f"longer IS NULL OR CAST(longer AS DECIMAL(20, 0)) * 100 < CAST(a AS DECIMAL(20, 0)) * {covered}"))
        .drop("longer")
    )
    # The best of every share first, so that a language is in one task with as many rows as shares have best ones.
    shares = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    share = Window.partitionBy("lang", F.pmod(F.hash("phrase"), F.lit(shares))).orderBy(*order)
    best = kept.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    best = best.where(F.col("rank") <= top)
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
