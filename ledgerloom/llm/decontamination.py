"""Benchmark passages in documents, with DataFrame functions only.

Windows of an item's own length slide over a document's words.  A window is
formed where it can be as similar to an item as asked: where a shingle of the
document is one of the item's, and so aligns the window with it.  (A window of
at least 0.8 similarity has runs of shared shingles so long that it is enough to
look at every ``stride``-th shingle of the document; ``stride`` follows from the
shortest item.)  Each window gets the SimHash of its shingles.  Fingerprints are
cut into blocks; two within the radius agree in a block but for few bits, so
the items' blocks are listed with all such changes and windows of the same
length are joined on equal blocks.  What is within the radius is verified by the
exact weighted Jaccard similarity of the shingles, weighted by occurrences.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import NO_WORD, checkpointed

SHINGLE = 5
THRESHOLD = 0.8
#: Bits in which fingerprints of windows may differ. At similarity 0.8 about 10 of 64 do, with a deviation of 3.
RADIUS = 20
BLOCKS = 7
#: Shingles of a benchmark that are broadcast; beyond, the join is shuffled.
BROADCAST_ROWS = 1_000_000


def word_list(text: str | Column) -> Column:
    """Lower-case words of a text; empty for NULL."""
    column = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(F.coalesce(column.cast("string"), F.lit(""))), NO_WORD), lambda w: w != "")


def shingle_list(words: Column, size: int = SHINGLE) -> Column:
    """Shingles of a word list as texts; a list shorter than the shingle is one shingle."""
    n = F.size(words)
    return F.when(n == 0, F.array().cast("array<string>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.greatest(n - (size - 1), F.lit(1))),
            lambda i: F.array_join(F.slice(words, i, F.lit(size)), " "),
        )
    )


def simhash(shingles: Column) -> Column:
    """64-bit SimHash of a bag of shingles; each occurrence votes for the bits of its hash."""
    votes = F.aggregate(
        F.transform(shingles, lambda s: F.xxhash64(s)),
        F.array_repeat(F.lit(0), 64),
        lambda sums, x: F.transform(sums, lambda v, b: v + F.lit(2) * F.getbit(x, b).cast("int") - F.lit(1)),
    )
    bits = F.transform(
        votes,
        lambda v, b: F.when(v > 0, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")),
    )
    # Never NULL, else joins would test the whole expression once more beforehand.
    return F.coalesce(F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x)), F.lit(0).cast("long"))


def _widths(blocks: int) -> list[tuple[int, int]]:
    """First bit and number of bits of each block."""
    size, more = divmod(64, blocks)
    out, at = [], 0
    for i in range(blocks):
        n = size + (i < more)
        out.append((at, n))
        at += n
    return out


def _changes(bits: int, flips: int) -> list[int]:
    """Masks of up to so many of the bits."""
    from itertools import combinations

    return [sum(1 << b for b in some) for k in range(flips + 1) for some in combinations(range(bits), k)]


def block_keys(fingerprint: Column, blocks: int) -> Column:
    """Block number and bits of each block."""
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("block"),
                F.call_function("shiftrightunsigned", fingerprint, F.lit(at)).bitwiseAND(F.lit((1 << n) - 1).cast("long")).alias("bits"),
            )
            for i, (at, n) in enumerate(_widths(blocks))
        ]
    )


def near_block_keys(fingerprint: Column, blocks: int, flips: int) -> Column:
    """Every block with every change of up to ``flips`` bits."""
    keys = block_keys(fingerprint, blocks)

    def changed(key: Column, n: int) -> Column:
        masks = F.array(*[F.lit(m).cast("long") for m in _changes(n, flips)])
        return F.transform(
            masks, lambda mask: F.struct(key["block"].alias("block"), key["bits"].bitwiseXOR(mask).alias("bits"))
        )

    wide = [changed(keys[i], n) for i, (_, n) in enumerate(_widths(blocks))]
    return F.concat(*wide)


def weighted_jaccard(a: Column, b: Column) -> Column:
    """Exact similarity of two bags of shingles: sum of the lesser counts over sum of the greater."""

    def count(bag: Column, s: Column) -> Column:
        return F.size(F.filter(bag, lambda x: x == s))

    shared = F.aggregate(
        F.array_distinct(F.array_intersect(a, b)),
        F.lit(0),
        lambda total, s: total + F.least(count(a, s), count(b, s)),
    )
    return shared / (F.size(a) + F.size(b) - shared)


def _stride(shingles: int) -> int:
    """How far apart looked-at shingles of a document may be so that a similar window holds a shared one.

    At similarity 0.8 at most a ninth of a window's shingles are not shared; so
    many split the others into runs of at least this length.
    """
    lost = shingles // 9
    return max(1, (shingles - lost) // (lost + 1))


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
) -> DataFrame:
    """``doc_id, item_id, first_word, n_words, similarity``: for each document and item found in it, the best window.

    ``documents``: ``doc_id, text``; ``benchmark``: ``item_id, text``; other
    columns are ignored.  NULL and empty texts match nothing; items of fewer
    words than a shingle are one shingle.  Rows without an id are ignored;
    repeated rows and rows of one id count once.  Of equally similar windows the
    first is reported.  An empty benchmark finds nothing.
    """
    items = (
        benchmark.where("item_id IS NOT NULL")
        .select(F.col("item_id"), word_list("text").alias("words"))
        .where(F.size("words") > 0)
        .dropDuplicates(["item_id", "words"])
        .select("item_id", "words", F.size("words").alias("n"), shingle_list(F.col("words")).alias("shingles"))
    )
    items = checkpointed(items.withColumn("fingerprint", simhash(F.col("shingles"))))
    # A handful of numbers: the sizes of short items, the least number of shingles, the longest item.
    short = sorted(r["n"] for r in items.where(F.col("n") < SHINGLE).select("n").distinct().collect())
    bounds = items.agg(
        F.min(F.when(F.col("n") >= SHINGLE, F.size("shingles"))).alias("least"), F.max("n").alias("longest")
    ).first()
    stride = _stride(bounds["least"]) if bounds["least"] else 1
    longest = bounds["longest"] or 1
    sizes = [(k, 1) for k in short] + ([(SHINGLE, stride)] if bounds["least"] or not short else [])

    def places(words: Column, first: Column, last: Column, size: int, step: int) -> Column:
        """Place and hash of every step-th run of so many words that starts within the two places."""
        stop = F.least(last, F.size(words) - size)
        return F.when(
            stop >= first,
            F.transform(
                F.sequence(first, stop, F.lit(step)),
                lambda i: F.struct(
                    i.alias("at"), F.xxhash64(F.lit(size), *[F.get(words, i + j) for j in range(size)]).alias("hash")
                ),
            ),
        ).otherwise(F.array().cast("array<struct<at:int,hash:bigint>>"))

    anchors = reduce(
        DataFrame.unionAll,
        [
            items.where(F.col("n") >= k if k == SHINGLE else F.col("n") == k).select(
                "n", F.explode(places(F.col("words"), F.lit(0), F.col("n"), k, 1)).alias("spot")
            )
            for k, _ in sizes
        ],
    )
    anchors = checkpointed(
        anchors.groupBy(F.col("spot.hash").alias("hash")).agg(F.collect_set(F.struct("spot.at", "n")).alias("places"))
    )
    small = anchors.count() <= BROADCAST_ROWS

    # explode_outer: for a plain explode the optimizer would test the arrays first, and so make them twice.
    # Documents in stretches that overlap by the longest item, so that what is copied per place stays short.
    own = stride * -(-max(256, longest) // stride)
    words = F.col("words")
    listed = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", word_list("text").alias("words"))
    stretches = (
        listed.where(F.size("words") > 0)
        .select(
            "doc_id",
            F.explode_outer(
                F.transform(
                    F.sequence(F.lit(0), F.size(words) - 1, F.lit(own)),
                    lambda c: F.struct(
                        c.alias("c"),
                        F.array_join(
                            F.slice(words, F.greatest(c - longest, F.lit(0)) + 1, F.least(c, F.lit(longest)) + own + longest + SHINGLE),
                            " ",
                        ).alias("line"),
                    ),
                )
            ).alias("stretch"),
        )
        .select("doc_id", F.col("stretch.c").alias("c"), F.col("stretch.line").alias("line"))
    )
    inner = F.split("line", " ")
    lead = F.least(F.col("c"), F.lit(longest))
    looks = [places(F.col("words"), F.col("lead"), F.col("lead") + (own - 1), k, step) for k, step in sizes]
    spots = stretches.select("doc_id", "c", "line", lead.alias("lead"), inner.alias("words")).select(
        "doc_id", "c", "line", "lead", F.explode_outer(F.concat(*looks) if len(looks) > 1 else looks[0]).alias("spot")
    )
    spots = spots.select("doc_id", "c", "line", "lead", F.col("spot.at").alias("i"), F.col("spot.hash").alias("hash"))
    # At most BROADCAST_ROWS hashes are broadcast, so nothing but windows is shuffled.
    met = spots.join(F.broadcast(anchors), "hash") if small else spots.join(anchors, "hash")
    n = F.col("n")
    found = checkpointed(
        met.select("doc_id", "c", "line", "lead", "i", F.explode("places").alias("place"))
        .select("doc_id", "c", "lead", "i", F.split("line", " ").alias("words"), F.col("place.at").alias("at"), F.col("place.n").alias("n"))
        .withColumn("from", F.greatest(F.least(F.col("i") - F.col("at"), F.size("words") - n), F.lit(0)))
        .select("doc_id", "n", (F.col("c") - F.col("lead") + F.col("from")).alias("start"), F.slice("words", F.col("from") + 1, n).alias("window"))
        .dropDuplicates(["doc_id", "n", "start", "window"])
    )
    windows = found.select("doc_id", "n", "start", shingle_list(F.col("window")).alias("shingles")).withColumn(
        "fingerprint", simhash(F.col("shingles"))
    )
    flips = radius // blocks
    keyed = windows.select("*", F.explode(block_keys(F.col("fingerprint"), blocks)).alias("key")).select(
        "doc_id", "n", "start", "shingles", "fingerprint", F.col("key.block").alias("block"), F.col("key.bits").alias("bits")
    )
    near = items.select(
        "item_id",
        "n",
        F.col("shingles").alias("item_shingles"),
        F.col("fingerprint").alias("item_fingerprint"),
        F.explode(near_block_keys(F.col("fingerprint"), blocks, flips)).alias("key"),
    ).select("item_id", "n", "item_shingles", "item_fingerprint", F.col("key.block").alias("block"), F.col("key.bits").alias("bits"))
    difference = F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint"))
    # A pair that agrees in several blocks is kept by the first of them alone.
    agree = [
        F.bit_count(difference.bitwiseAND(F.lit((((1 << n) - 1) << at) - (1 << 64 if at + n == 64 else 0)).cast("long"))) <= flips
        for at, n in _widths(blocks)
    ]
    first = reduce(lambda rest, i: F.when(agree[i], F.lit(i)).otherwise(rest), reversed(range(blocks)), F.lit(-1))
    pairs = (
        keyed.join(near, ["n", "block", "bits"])
        .where(F.bit_count(difference) <= radius)
        .where(F.col("block") == first)
        .withColumn("similarity", weighted_jaccard(F.col("shingles"), F.col("item_shingles")))
        .where(F.col("similarity") >= threshold)
    )
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n"))
    return (
        pairs.groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select(
            "doc_id",
            "item_id",
            (-F.col("best.back")).alias("first_word"),
            F.col("best.n").alias("n_words"),
            F.col("best.similarity").alias("similarity"),
        )
    )
