"""Near-duplicate documents by DartMinHash signatures.

A document is its multiset of five-word shingles (a shorter text is one shingle
of all its words); its weight of a shingle is how often it occurs.  Darts are
thrown at random, the same for all documents, into each shingle's region: for a
shingle they form a Poisson process over weight and rank, made from hashes of
the shingle.  A document keeps the darts below its weight, deals them to the
coordinates by another hash, and the dart of the least rank in a coordinate is
its entry.  Two documents share an entry with the probability of their weighted
Jaccard similarity.  Throwing begins at a rank so low that some darts per
coordinate are expected and goes on only while a coordinate is empty, so the
work is linear in the shingles.

Equal texts are one from the start.  Texts that share a band are linked if the
exact weighted Jaccard similarity of their shingles reaches the threshold.  To
keep a band of thousands of texts linear, each is compared with the band's first
text, the one that shares bands with most others, then those of other classes
with the next few; only where a band still holds several classes, all pairs
across them are compared too, so no link that would join two classes is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import at_hand, checkpointed, slices, stored, texts_of, words, worker_cache

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 21, 6
#: Texts of a band, those that meet most others, with which all others are compared first.
FIRSTS = 4
#: Bits of an entry that are kept to tell how many entries two texts share.
PLANES = 8
#: Shingles of the texts that a task keeps while it compares pairs.
CACHED_SHINGLES = 500_000
#: Bits of the map that bounds the shingles two texts do not share.
MAP_BITS = 1024
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: well spread hashes of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _uniform(h: np.ndarray) -> np.ndarray:
    """Numbers above 0 and up to 1."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def shingles(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, hash and count of each distinct shingle, ordered by document and hash."""
    lists = [words(t) for t in texts]
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = [w for found in lists for w in found]
    if not flat:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = pd.util.hash_array(np.array(flat, object), categorize=True)
    ends = np.cumsum(n)
    doc = np.repeat(np.arange(len(lists)), n)
    left = np.repeat(ends, n) - np.arange(len(h))  # words from here to the end of the text
    total = np.repeat(n, n)
    value = np.zeros(len(h), np.uint64)
    for k in range(size):
        shifted = np.zeros(len(h), np.uint64)
        shifted[: max(len(h) - k, 0)] = h[k:]
        value = mix(value * _ODD + np.where(left > k, shifted, np.uint64(0)) + np.uint64(k))
    keep = (left >= size) | (left == total)
    doc, value = doc[keep], value[keep]
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])])
    return doc[first], value[first], np.diff(np.r_[first, len(doc)])


def darts(
    doc: np.ndarray, element: np.ndarray, weight: np.ndarray, documents: int, coordinates: int, seed: int = 1
) -> np.ndarray:
    """Signatures (documents x coordinates) of weighted sets; documents without elements keep zeros.

    Region of an element: weight cells [0, 1), [1, 2), [2, 4), [4, 8) ... by
    rank.  The darts of a cell have exponential gaps in rank, of a rate equal to
    the cell's width, and a uniform weight within the cell.
    """
    cells_d, cells_e, cells_low, cells_w = [], [], [], []
    low = 0.0
    while True:
        use = weight > low
        if not use.any():
            break
        cells_d.append(doc[use])
        cells_e.append(mix(element[use] + np.uint64(int(_ODD) * (int(low) + seed) & 0xFFFFFFFFFFFFFFFF)))
        cells_low.append(np.full(int(use.sum()), low))
        cells_w.append(weight[use].astype(np.float64))
        low = low * 2 if low else 1.0
    signature = np.zeros((documents, coordinates), np.uint64)
    if not cells_d:
        return signature
    d, e = np.concatenate(cells_d), np.concatenate(cells_e)
    lows, w = np.concatenate(cells_low), np.concatenate(cells_w)
    width = np.maximum(lows, 1.0)
    mass = np.bincount(doc, weight, documents)
    goal = coordinates * (np.log(coordinates) + 2.0)
    limit = np.where(mass > 0, goal / np.maximum(mass, 1e-12), 0.0)
    best = np.full(documents * coordinates, np.inf)
    name = signature.ravel()
    rank, count = np.zeros(len(d)), np.zeros(len(d), np.uint64)
    open_ = np.arange(len(d))
    while len(open_):
        at = open_
        # Next dart of every open cell, until its rank passes the document's limit.
        held = []
        while len(at):
            key = mix(e[at] + count[at] * _ODD)
            gap = -np.log(_uniform(key)) / width[at]
            reached = rank[at] + gap
            within = reached <= limit[d[at]]
            at, key, reached = at[within], key[within], reached[within]
            rank[at] = reached
            count[at] += np.uint64(1)
            below = lows[at] + width[at] * _uniform(mix(key ^ np.uint64(0x5851F42D4C957F2D))) <= w[at]
            held.append((at[below], key[below], reached[below]))
        if held:
            place, key, reached = (np.concatenate(x) for x in zip(*held, strict=True))
            slot = d[place] * coordinates + (mix(key + np.uint64(7)) % np.uint64(coordinates)).astype(np.int64)
            order = np.argsort(-reached, kind="stable")  # the last written is the least
            slot, key, reached = slot[order], key[order], reached[order]
            least = np.full(len(best), np.inf)
            least[slot] = reached
            who = np.zeros(len(best), np.uint64)
            who[slot] = key
            better = least < best
            best[better], name[better] = least[better], who[better]
        empty = np.isinf(best).reshape(documents, coordinates).any(1) & (mass > 0)
        limit = np.where(empty, limit * 2, limit)
        open_ = np.flatnonzero(empty[d])
    return signature


def planes(signature: np.ndarray) -> np.ndarray:
    """The low ``PLANES`` bits of the entries, bit by bit, 64 entries to a number (texts x numbers)."""
    n, k = signature.shape
    wide = np.zeros((n, -(-k // 64) * 64), np.uint64)
    wide[:, :k] = signature
    power = np.uint64(1) << np.arange(64, dtype=np.uint64)
    out = [
        (((wide[:, at : at + 64] >> np.uint64(b)) & np.uint64(1)) * power).sum(1, dtype=np.uint64)
        for at in range(0, wide.shape[1], 64)
        for b in range(PLANES)
    ]
    return np.stack(out, 1)


def entries_unlike(a: str, b: str, coordinates: int = BANDS * ROWS) -> Column:
    """Entries in which two texts' planes differ."""
    found = F.lit(0)
    for half in range(-(-coordinates // 64)):
        differs = F.lit(0).cast("long")
        for i in range(half * PLANES, (half + 1) * PLANES):
            differs = differs.bitwiseOR(F.get(F.col(a), F.lit(i)).bitwiseXOR(F.get(F.col(b), F.lit(i))))
        found = found + F.bit_count(differs)
    return found


def first_shared_band(a: str, b: str, bands: int = BANDS) -> Column:
    """The first of the bands that two texts have in common; NULL if there is none."""
    shared = F.lit(None).cast("long")
    for i in reversed(range(bands)):
        one, other = F.get(F.col(a), F.lit(i)), F.get(F.col(b), F.lit(i))
        shared = F.when(one == other, one).otherwise(shared)
    return shared


def most_unlike(threshold: float, coordinates: int = BANDS * ROWS) -> int:
    """Entries that differ in two texts of that similarity, with four standard deviations more: 1 pair in 30 000 has more."""
    return math.ceil(coordinates * (1 - threshold) + 4 * math.sqrt(coordinates * threshold * (1 - threshold)))


def parity_maps(doc: np.ndarray, value: np.ndarray, count: np.ndarray, documents: int) -> np.ndarray:
    """Whether an odd number of a text's shingles falls into each of ``MAP_BITS`` cells (texts x numbers).

    Each bit in which two texts differ takes a shingle of its own that they do not share.
    """
    odd = count % 2 == 1
    cell = (mix(value[odd] + _ODD) % np.uint64(MAP_BITS)).astype(np.int64)
    held = np.bincount(doc[odd] * MAP_BITS + cell, minlength=documents * MAP_BITS) & 1
    return np.packbits(held.astype(np.uint8).reshape(documents, MAP_BITS), axis=1).view(np.int64)


def may_be_like(a: str, b: str, size_a: str, size_b: str, threshold: float) -> Column:
    """False only for texts whose maps prove a similarity below the threshold: no link is lost.

    With S shingles together, D of them not shared, the similarity is (S - D) / (S + D).
    """
    unshared = F.lit(0)
    for i in range(MAP_BITS // 64):
        unshared = unshared + F.bit_count(F.get(F.col(a), F.lit(i)).bitwiseXOR(F.get(F.col(b), F.lit(i))))
    together = F.col(size_a) + F.col(size_b)
    return unshared * (1 + threshold) <= together * (1 - threshold + 1e-9)


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """Hashes of the bands of the texts' signatures (texts x bands)."""
    texts = signature
    out = np.zeros((len(texts), bands), np.uint64)
    for r in range(rows):
        out = mix(out * _ODD + signature.reshape(len(texts), bands, rows)[:, :, r])
    return out + np.arange(bands, dtype=np.uint64)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_cache("near duplicates", None, dict)
    for batch in batches:
        for piece in slices(batch, size=1 << 20):
            texts = texts_of(piece)
            full = np.array([bool(words(t)) for t in texts])
            doc, value, count = shingles(texts)
            signature = darts(doc, value, count, len(texts), BANDS * ROWS)
            lists = [
                pa.ListArray.from_arrays(
                    pa.array(np.arange(len(texts) + 1) * x.shape[1], pa.int32()), pa.array(x.view(np.int64).ravel())
                )
                for x in (band_keys(signature), planes(signature), parity_maps(doc, value, count, len(texts)))
            ]
            size = pa.array(np.bincount(doc, count, len(texts)).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), *lists, size], names=["key", "bands", "planes", "map", "size"]
            ).filter(pa.array(full))


def similarity(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two texts' shingles; 0 if one has no word."""
    doc, value, count = shingles([a, b])
    if not len(doc) or doc[0] == doc[-1]:
        return 0.0
    cut = int(np.searchsorted(doc, 1))
    _, i, j = np.intersect1d(value[:cut], value[cut:], assume_unique=True, return_indices=True)
    shared = np.minimum(count[:cut][i], count[cut:][j]).sum()
    return float(shared / (count.sum() - shared))


def _verified(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    # Whole texts' shingles, of the last few texts of this task alone.
    worker_cache("near duplicates", None, dict)
    cache: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
    held = 0

    def of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
        nonlocal held
        found = cache.get(text)
        if found is None:
            if len(cache) > 200 or held > CACHED_SHINGLES:
                cache.clear()
                held = 0
            _, value, count = shingles([text])
            found = cache[text] = (value, count)
            held += len(value)
        return found

    for batch in batches:
        for piece in slices(batch, "text_a", rows=128, size=1 << 20):
            keep = []
            for a, b in zip(texts_of(piece, "text_a"), texts_of(piece, "text_b"), strict=True):
                (va, ca), (vb, cb) = of(a), of(b)
                _, i, j = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
                shared = np.minimum(ca[i], cb[j]).sum()
                keep.append(bool(shared >= threshold * (ca.sum() + cb.sum() - shared)) and shared > 0)
            yield piece.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Of the pairs ``a, b`` of text keys, those of enough similarity; ``texts``: ``key, text``, one row a key."""
    first = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(first, "a").join(second, "b")
    return both.mapInArrow(lambda it: _verified(it, threshold), "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """Least key of each connected component: ``key, root`` for every key in ``links`` (``a, b``).

    Labels fall to the least one among the neighbours, then to that one's own
    label, until nothing changes: rounds grow with the logarithm of the longest path.
    """
    links = checkpointed(links.select("a", "b").where("a != b").dropDuplicates())
    edges = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = edges.groupBy(F.col("a").alias("key")).agg(F.least(F.col("key"), F.min("b")).alias("root"))
    labels = checkpointed(labels)
    while True:
        near = (
            edges.join(labels.withColumnRenamed("key", "a"), "a")
            .groupBy(F.col("b").alias("key"))
            .agg(F.min("root").alias("near"))
        )
        fallen = labels.join(near, "key").select("key", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        fallen = checkpointed(fallen)
        up = fallen.select(F.col("key").alias("root"), F.col("root").alias("up"))
        jumped = fallen.join(up, "root", "left").select("key", "was", F.coalesce("up", "root").alias("root"))
        jumped = checkpointed(jumped)
        changed = jumped.where("was != root").limit(1).count()
        labels = jumped.select("key", "root")
        if not changed:
            return labels


def near_duplicates(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, class_id, representative`` for each row of ``documents`` (``doc_id, text``; other columns are ignored).

    ``class_id`` is the least ``doc_id`` of the class, ``representative`` marks
    the row that has it.  Texts without a word (NULL and empty ones too) are like
    nothing else: each row is a class of its own, as is a row without an id,
    whose ``class_id`` is NULL.  Repeated rows are copies; of rows with one id
    and one text none is more than another, so both are representatives.
    """
    at_hand(documents.sparkSession)
    rows = documents.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string").alias("text"),
        F.unhex(F.md5(F.col("text").cast("binary"))).alias("key"),
    )
    sized = rows.where("doc_id IS NOT NULL AND text IS NOT NULL")
    bands = sized.select("key", "text").mapInArrow(
        _banded, "key binary, bands array<long>, planes array<long>, map array<long>, size long"
    )
    # One row per text; equal texts have equal bands.
    bands = stored(
        bands.groupBy("key").agg(*[F.first(c).alias(c) for c in ("bands", "planes", "map", "size")]), "bands"
    )
    entries = bands.select("key", F.explode("bands").alias("band"))
    full = entries.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    crowded = checkpointed(entries.join(full, "band"))
    # The text that meets most others is the likeliest to be like all of them.
    central = crowded.groupBy("key").agg(F.sum("n").alias("met"))
    crowded = checkpointed(crowded.join(central, "key").select("band", "key", "met"))
    order = F.row_number().over(Window.partitionBy("band").orderBy(F.desc("met"), "key"))
    firsts = crowded.withColumn("r", order).where(F.col("r") <= FIRSTS).select("band", F.col("key").alias("a"), "r")
    firsts = checkpointed(firsts)
    ids = sized.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    chosen = crowded.select("key").dropDuplicates().join(ids, "key")
    # The text of each key that shares a band, from the first row that has it.
    texts = stored(
        sized.join(chosen, ["key", "doc_id"]).groupBy("key").agg(F.first("text").alias("text")), "texts"
    )

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("a", "key").alias("a"), F.greatest("a", "key").alias("b")).dropDuplicates()

    star = crowded.join(firsts.where("r = 1"), "band").where("a != key")
    links = checkpointed(verified(ordered(star), texts, threshold))
    roots = components(links)

    def mixed() -> DataFrame:
        """Bands that hold several classes."""
        placed = crowded.join(roots, "key", "left").select("band", "key", F.coalesce("root", "key").alias("root"))
        bands_ = placed.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x != y")
        return checkpointed(placed.join(bands_.select("band"), "band"))

    # Texts of other classes than the band's next first ones, compared with those.
    rest = mixed()
    seconds = rest.join(firsts.where("r > 1").withColumnRenamed("a", "key"), ["band", "key"]).select(
        "band", F.col("key").alias("a"), F.col("root").alias("own")
    )
    more = checkpointed(
        verified(ordered(rest.join(seconds, "band").where("root != own")).join(links, ["a", "b"], "left_anti"), texts, threshold)
    )
    if more.limit(1).count():
        links = links.unionAll(more)
        roots = components(links)
        rest = mixed()
    # What is left: all pairs of a band across its classes.
    # Within the join, maps and signatures too unlike for the threshold are left out, and a pair of several
    # bands comes from the first of them alone (all of them hold both classes, so all are here).
    rest = rest.join(bands, "key")
    left, right = rest.alias("l"), rest.alias("r")
    like = may_be_like("l.map", "r.map", "l.size", "r.size", threshold)
    like = like & (entries_unlike("l.planes", "r.planes") <= most_unlike(threshold))
    once = first_shared_band("l.bands", "r.bands") == F.col("l.band")
    across = left.join(right, F.expr("l.band = r.band AND l.key < r.key AND l.root != r.root") & like & once).select(
        F.col("l.key").alias("a"), F.col("r.key").alias("b")
    )
    last = checkpointed(verified(across.dropDuplicates(), texts, threshold))
    if last.limit(1).count():
        roots = components(links.unionAll(last))
    class_of = (
        ids.join(roots, "key", "left")
        .select("key", "doc_id", F.coalesce("root", "key").alias("root"))
    )
    least = class_of.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    wordless = ~F.lower("text").rlike(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]")
    named = class_of.join(least, "root").select("key", "class_id")
    out = rows.select(
        "doc_id", F.when(wordless | F.col("doc_id").isNull(), None).otherwise(F.col("key")).alias("key")
    ).join(named, "key", "left")
    class_id = F.coalesce("class_id", "doc_id")
    return out.select("doc_id", class_id.alias("class_id"), F.coalesce(class_id == F.col("doc_id"), F.lit(True)).alias("representative"))
