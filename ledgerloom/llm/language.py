"""Language identification by cross-parsing.

A text is parsed against labelled text of a language by longest matches: each
phrase is the longest stretch that occurs in the labelled text, as its suffix
automaton tells.  Few long phrases mean the same language.  A parse begins anew
at each word (letters between two blanks), so the phrases of a word are worked
out once and kept.  The score of a language is its phrases per letter; the
fewest win.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import Codes, at_hand, fold, slices, texts_of, with_text, worker_cache

#: Bounds of the labelled sample: documents a language, bytes of one of them, languages.
SAMPLE_DOCUMENTS = 32
SAMPLE_BYTES = 8_000
MOST_LANGUAGES = 256

_LETTERS = re.compile(r"[^\W\d_]+")
#: Weight of the share of phrases saved against the next language when it becomes a score.
_SHARPNESS = 8.0
#: Deviations by which a text may have more phrases than the limit of its language.
_SLACK = 3.0


class SuffixAutomaton:
    """All stretches of a text; built letter by letter in linear time.

    Most states have one way on: the first way of each stands in flat arrays,
    only further ones in a dictionary.
    """

    def __init__(self, text: str):
        self.letter: list[str] = [""]
        self.target = array("i", [-1])
        self.more: dict[int, dict[str, int]] = {}
        one: dict[str, str] = {}
        link, length = array("i", [-1]), array("i", [0])
        last = 0
        for c in text:
            c = one.setdefault(c, c)
            new = len(link)
            self._add("", -1)
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and self.way(p, c) < 0:
                self._lead(p, c, new)
                p = link[p]
            if p >= 0:
                q = self.way(p, c)
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    copy = len(link)
                    self._add(self.letter[q], self.target[q])
                    if q in self.more:
                        self.more[copy] = dict(self.more[q])
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p >= 0 and self.way(p, c) == q:
                        self._lead(p, c, copy)
                        p = link[p]
                    link[q] = link[new] = copy
            last = new

    def _add(self, letter: str, target: int) -> None:
        self.letter.append(letter)
        self.target.append(target)

    def _lead(self, state: int, c: str, to: int) -> None:
        if self.letter[state] in ("", c):
            self.letter[state], self.target[state] = c, to
        else:
            self.more.setdefault(state, {})[c] = to

    def way(self, state: int, c: str) -> int:
        """The state that a letter leads to; -1 if none."""
        if self.letter[state] == c:
            return self.target[state]
        found = self.more.get(state)
        return -1 if found is None else found.get(c, -1)

    def longest_match(self, text: str, start: int) -> int:
        """Length of the longest stretch from ``start`` on that occurs in the automaton's text."""
        letter, target, more = self.letter, self.target, self.more
        state = 0
        for at in range(start, len(text)):
            c = text[at]
            if letter[state] == c:
                state = target[state]
            else:
                found = more.get(state)
                state = -1 if found is None else found.get(c, -1)
                if state < 0:
                    return at - start
        return len(text) - start

    def phrases(self, text: str) -> int:
        """Longest matches needed to cover a text; a letter that never occurs is a phrase of its own."""
        at = count = 0
        while at < len(text):
            at += max(1, self.longest_match(text, at))
            count += 1
        return count


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def labelled_sample(documents: DataFrame, documents_per_language: int = SAMPLE_DOCUMENTS) -> dict[str, str]:
    """Words of a bounded number of whole labelled texts per language, the same whatever the order of the rows.

    Texts of 200 to ``SAMPLE_BYTES`` bytes come first, in the order of their
    hashes, then others, the short before the long.
    """
    size = F.octet_length("text").cast("long")
    odd = (size < 200) | (size > SAMPLE_BYTES)
    order = [odd, F.when(odd, size).otherwise(F.xxhash64("text")), F.col("text")]
    rows = (
        documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
        .select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
        .withColumn("__rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
        .where(F.col("__rank") <= documents_per_language)
        .withColumn("__held", F.sum(size).over(Window.partitionBy("lang").orderBy("__rank")))
        .where((F.col("__rank") == 1) | (F.col("__held") <= documents_per_language * SAMPLE_BYTES))
    )
    found: dict[str, list[str]] = {}
    for row in rows.orderBy("lang", "__rank").limit(MOST_LANGUAGES * documents_per_language).collect():
        found.setdefault(row["lang"], []).append(row["text"])
    return {lang: " ".join(w for t in texts for w in words_of(t)) for lang, texts in sorted(found.items())}


def phrase_limits(sample: dict[str, str]) -> list[tuple[float, float]]:
    """Phrases per letter up to which a text is in each language of the sample, and the deviation of a word's phrases.

    The second half of a language's words is parsed against the first, as it is
    and with each word spelt backwards: the same letters in no language.  The
    limit is halfway between the two rates.  One word alone sets no limit.
    """
    found = []
    for text in sample.values():
        words = text.split()
        half = len(words) // 2
        if not half:
            found.append((np.inf, 0.0))
            continue
        automaton = SuffixAutomaton(f" {' '.join(words[:half])} ")
        letters = np.array([len(w) for w in words[half:]])
        own = np.array([automaton.phrases(f" {w} ") for w in words[half:]])
        backwards = sum(automaton.phrases(f" {w[::-1]} ") for w in words[half:])
        rate = own.sum() / letters.sum()
        found.append((float(max(rate, (rate + backwards / letters.sum()) / 2)), float((own - rate * letters).std())))
    return found


def _parser(sample: dict[str, str]) -> tuple[list[str], Codes]:
    """Automata of the sample, one set per Python worker; codes give the phrases of a word in every language."""

    def built() -> tuple[list[str], Codes]:
        automata = [SuffixAutomaton(f" {text} ") for text in sample.values()]

        def phrases(word: str) -> list[int]:
            text = f" {word} "
            return [a.phrases(text) for a in automata]

        return list(sample), Codes(phrases, most=200_000)

    return worker_cache("language", tuple(sample.items()), built)


def _predict(sample, names, limits, column, kept):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, codes = _parser(sample.value)
        k = len(langs)
        for batch in batches:
            for piece in slices(batch, column, size=1 << 20):
                codes.trim()
                held: list[int] = []
                ends, letters = [0], []
                for text in texts_of(piece, column):
                    words = words_of(text.decode("utf-8", "replace"))
                    held += map(codes.__getitem__, words)
                    ends.append(len(held))
                    letters.append(sum(map(len, words)))
                n = piece.num_rows
                doc = np.repeat(np.arange(n), np.diff(ends))
                total = np.zeros((n, max(k, 1)))
                if k and held:
                    # Only the rows of the slice's own words are copied.
                    rows = np.frombuffer(codes.flat, np.intc).reshape(-1, k)[np.array(held, np.int64)]
                    for j in range(k):
                        total[:, j] = np.bincount(doc, rows[:, j], n)
                known = (np.array(letters) > 0) & (k > 0)
                rate = total / np.maximum(np.array(letters), 1)[:, None]
                best = rate.argmin(1)
                if limits:
                    limit, spread = np.array(limits).T
                    most = limit[best] + _SLACK * spread[best] * np.sqrt(np.diff(ends)) / np.maximum(letters, 1)
                    known &= rate.min(1) <= most
                share = np.exp(-_SHARPNESS * (rate / np.maximum(rate.min(1, keepdims=True), 1e-9) - 1))
                score = np.where(known, 1 / share.sum(1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        *piece.columns[:kept],
                        pa.array(
                            [langs[b] if y else "und" for b, y in zip(best.tolist(), known.tolist(), strict=True)],
                            pa.string(),
                        ),
                        pa.array(np.clip(score, 0.0, 1.0)),
                    ],
                    names=[*piece.schema.names[:kept], *names],
                )

    return run


def predicted(
    documents: DataFrame,
    sample: dict[str, str],
    keep: list[str],
    names: tuple[str, str] = ("lang_pred", "score"),
    limits: list[tuple[float, float]] | None = None,
) -> DataFrame:
    """Columns ``keep`` of the documents with the predicted language and its score, so named.

    ``limits`` (see ``phrase_limits``): a text with more phrases than its best language allows is ``und`` too.
    """
    at_hand(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(sample)
    rows, column = with_text(documents, keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(keep)])
    return rows.mapInArrow(
        _predict(shared, names, limits, column, len(keep)), f"{fields}, `{names[0]}` string, `{names[1]}` double"
    )


def language_id(documents: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row.

    ``documents``: ``doc_id, text, lang``; other columns are ignored.  Learns
    from ``training`` (by default the documents outside the held-out fifth)
    with a text and a label: at most ``SAMPLE_DOCUMENTS`` whole texts of up to
    ``SAMPLE_BYTES`` a language, as the order of their hashes has them, and at most
    ``MOST_LANGUAGES`` languages, the first by name.  A text that is NULL or without a letter is ``und`` with score 0, and so is every
    text if nothing is labelled.  A NULL id is not held out and not learnt from.
    Of languages with equally few phrases the first by name wins.
    """
    learn = documents.where(fold("doc_id") != 0) if training is None else training
    rows = documents.select(
        F.col("doc_id").cast("long"), F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "text"
    )
    return predicted(rows, labelled_sample(learn), ["doc_id", "held_out"])
