"""SentencePiece encoding and decoding with a streaming Viterbi search.

The search runs over the characters and keeps, for each boundary, the one last
piece of the best segmentation up to it, as a backpointer.  Which piece that is
follows from the model: for a BPE model the last piece is the one whose pair
with the piece before it stays unmerged when both are encoded together (only one
piece has that property), for a unigram model it is the piece of the highest
total score.  Only the boundaries within the longest piece of the head can still
be continued, so the window is bounded; whenever all backpointer paths from them
meet in one boundary, the ids up to it are committed and their cells dropped.

No piece spans two characters which stand together in no piece of the model, so
every path meets between them.  Texts are cut at the frequent ones of these
places (before a blank, around line breaks, between a letter and a punctuation
mark that follows no letter in any piece), and the search of a stretch is kept
for when it returns.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Codes, at_hand, gather, slices, spans, texts_of, worker_cache

BLANK = "▁"
#: Pairs of pieces and stretches that a Python worker remembers: about 30 and 60 MB.
MOST_PAIRS = 400_000
MOST_STRETCHES = 400_000


def piece_model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceModel:
    """The pieces of a model file, and what is fixed by them."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.library = SentencePieceProcessor(model_file=path)
        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kind = pb.ModelProto.SentencePiece
        self.bpe = model.trainer_spec.model_type == 2
        self.piece = [p.piece for p in model.pieces]
        self.kind = [p.type for p in model.pieces]
        self.id = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (kind.NORMAL, kind.USER_DEFINED)}
        self.score = [p.score for p in model.pieces]
        self.byte = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == kind.UNKNOWN)
        self.longest = max(map(len, self.id))
        self.plain = model.normalizer_spec.name == "identity" and not model.normalizer_spec.remove_extra_whitespaces
        self.prefix = model.normalizer_spec.add_dummy_prefix
        self.worst = min(self.score) - 10
        beside = {p[i : i + 2] for p in self.id for i in range(len(p) - 1)}
        lines = "\n" if not any("\n" in p for p in beside) else ""
        marks = re.escape("".join(c for c in ".,;:!?|" if not any(p[1] == c and p[0].isalpha() for p in beside)))
        #: Blanks and what follows them up to the next place that no piece spans.
        self.stretch = re.compile(
            (rf"{lines}|" if lines else "") + (rf" *[^\W\d_]++(?=[{marks}])|" if marks else "") + rf" *[^ {lines}]+| +"
        )
        self.by_blanks = not any(BLANK in p.lstrip(BLANK) for p in self.id)
        #: The longest piece that ends in these three characters.
        self.tails: dict[str, int] = {}
        for p in self.id:
            if len(p) > 2:
                self.tails[p[-3:]] = max(len(p), self.tails.get(p[-3:], 0))
        #: Lengths of the pieces that end in these four characters, the longest first.
        self.sizes: dict[str, tuple[int, ...]] = {}
        held: dict[str, set[int]] = {}
        for p in self.id:
            if len(p) > 3:
                held.setdefault(p[-4:], {1, *(k for k in (2, 3) if p[-k:] in self.id)}).add(len(p))
        for tail, found in held.items():
            self.sizes[tail] = tuple(sorted(found, reverse=True))
        #: By the numbers of two pieces, left * span + right: whether they stay two.
        self.span = len(self.piece) + 0x110000
        self.together: dict[int, bool] = {}

    def normal(self, text: str) -> str:
        """The text as the model sees it: its own normalisation, blanks made visible, the blank in front."""
        if not text:
            return ""
        if self.plain:
            return (BLANK if self.prefix else "") + text.replace(" ", BLANK)
        return self.library.normalize(text)

    def stretches(self, text: str) -> list[str]:
        """Parts of a normalised text between which all paths meet, with plain blanks."""
        if not self.by_blanks:
            return [text] if text else []
        return self.stretch.findall(text.replace(BLANK, " "))

    def merged(self, text: str) -> list[str]:
        """Pairs of neighbours merged by score, the leftmost of equals first."""
        parts = list(text)
        while len(parts) > 1:
            best = max(
                ((self.score[i], -k) for k in range(len(parts) - 1) if (i := self.id.get(parts[k] + parts[k + 1])) is not None),
                default=None,
            )
            if best is None:
                break
            k = -best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def stable(self, left: str, right: str) -> bool:
        """Whether two pieces stay two when encoded together."""
        key = self.number(left) * self.span + self.number(right)
        known = self.together.get(key)
        if known is None:
            if len(self.together) > MOST_PAIRS:
                self.together.clear()
            known = self.together[key] = self.merged(left + right) == [left, right]
        return known

    def number(self, piece: str) -> int:
        """A piece's id; beyond them the character that is none."""
        i = self.id.get(piece)
        return len(self.piece) + ord(piece) if i is None else i

    def ids_of(self, piece: str) -> list[int]:
        i = self.id.get(piece)
        if i is not None:
            return [i]
        if self.byte:
            return [self.byte[b] for b in piece.encode("utf-8")]
        return [self.unknown]

    def search(self, text: str) -> Iterator[str]:
        """The pieces of a normalised text, committed as soon as all open paths agree."""
        base = 0  # boundary up to which pieces are committed
        back = [0]  # start of the last piece of each boundary from base on
        number = [0]  # and its number
        total = [0.0]
        n, longest, known, tails, together, bpe = len(text), self.longest, self.id, self.tails, self.together, self.bpe
        span, others = self.span, len(self.piece)
        for end in range(1, n + 1):
            best, value, own = end - 1, -np.inf, -1
            reach = tails.get(text[end - 3 : end], 2) if end > 2 else end
            for start in range(max(base, end - reach), end):
                piece = text[start:end]
                i = known.get(piece)
                if i is None:
                    if end - start > 1:
                        continue
                    i = others + ord(piece)
                if not bpe:
                    score = total[start - base] + (self.score[i] if i < others else self.worst)
                    if score > value:
                        best, value = start, score
                    continue
                if start:
                    stays = together.get(number[start - base] * span + i)
                    if not (self.stable(text[back[start - base] : start], piece) if stays is None else stays):
                        continue
                best, own = start, i
                break
            back.append(best)
            number.append(self.number(text[best:end]) if bpe and own < 0 else own)
            total.append(value)
            if end - base >= 2 * longest or end == n:
                # Where do the paths of all boundaries that can still be continued meet?
                heads = {end} if end == n else set(range(end - longest + 1, end + 1))
                while len(heads) > 1:
                    last = max(heads)
                    heads.remove(last)
                    heads.add(back[last - base])
                meet = heads.pop()
                if meet > base:
                    found, at = [], meet
                    while at > base:
                        found.append(text[back[at - base] : at])
                        at = back[at - base]
                    yield from reversed(found)
                    # The pair test looks at the last committed piece too.
                    keep = back[meet - base]
                    back, number, total = back[meet - base :], number[meet - base :], total[meet - base :]
                    back[0], base = keep, meet

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        return [i for x in self.stretches(self.normal(text)) for i in self.encode_stretch(x)]

    def short(self, text: str) -> list[str]:
        """The same search for a text within two windows, in which nothing is committed before the end."""
        back, number = [0], [0]
        known, sizes, together, span, others = self.id, self.sizes, self.together, self.span, len(self.piece)
        for end in range(1, len(text) + 1):
            best, own = end - 1, -1
            for size in sizes.get(text[end - 4 : end], (3, 2, 1)) if end > 3 else range(end, 0, -1):
                start = end - size
                if start < 0:
                    continue
                piece = text[start:end]
                i = known.get(piece)
                if i is None and size == 1:
                    i = others + ord(piece)
                if i is not None:
                    if not start:
                        best, own = 0, i
                        break
                    stays = together.get(number[start] * span + i)
                    if self.stable(text[back[start] : start], piece) if stays is None else stays:
                        best, own = start, i
                        break
            back.append(best)
            number.append(self.number(text[best:end]) if own < 0 else own)
        found, at = [], len(text)
        while at:
            found.append(text[back[at] : at])
            at = back[at]
        return found[::-1]

    def encode_stretch(self, text: str) -> list[int]:
        out: list[int] = []
        text = text.replace(" ", BLANK)
        for piece in self.short(text) if self.bpe and len(text) < 2 * self.longest else self.search(text):
            out += self.ids_of(piece)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes joined to characters, visible blanks made blanks, the blank in front dropped."""
        return self.text(b"".join(self.raw[i] for i in ids))

    def text(self, raw: bytes) -> str:
        """The text of the bytes of pieces."""
        text = raw.decode("utf-8", "replace").replace(BLANK, " ")
        return text[1:] if self.prefix and text[:1] == " " else text

    @property
    def raw(self) -> list[bytes]:
        found = self.__dict__.get("_raw")
        if found is None:
            value = {i: bytes([b]) for b, i in self.byte.items()}
            found = self.__dict__["_raw"] = [value.get(i, p.encode("utf-8")) for i, p in enumerate(self.piece)]
        return found


def model_and_codes(path: str) -> tuple[PieceModel, Codes]:
    """One model per Python worker and the ids of its stretches, until another operator runs there."""

    def made() -> tuple[PieceModel, Codes]:
        model = PieceModel(path)
        return model, Codes(model.encode_stretch, most=MOST_STRETCHES)

    return worker_cache("pieces", path, made)


def piece_model(path: str) -> PieceModel:
    return model_and_codes(path)[0]


def piece_codes(path: str) -> Codes:
    return model_and_codes(path)[1]


def _encoded(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, codes = model_and_codes(path)
        raw = np.frombuffer(b"".join(model.raw), np.uint8)
        width = np.fromiter(map(len, model.raw), np.int64, len(model.raw))
        at = spans(width)[:-1]
        for batch in batches:
            # The places of all bytes of a slice are held at once.
            for piece in slices(batch, size=1 << 20):
                codes.trim()
                texts = [t.decode("utf-8", "replace") for t in texts_of(piece)]
                normal = [model.normal(t) for t in texts]
                held: list[int] = []
                ends = [0]
                for text in normal:
                    held += map(codes.__getitem__, model.stretches(text))
                    ends.append(len(held))
                ids, sizes = codes.runs(np.array(held, np.int64))
                reach = spans(sizes)[ends]
                back = gather(raw, at[ids], width[ids]).tobytes()
                place = spans(width[ids])[reach].tolist()
                plain = ids.astype("<u4")
                reach = reach.tolist()
                out = {
                    "doc_id": piece.column(piece.schema.get_field_index("doc_id")),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                    "n_pieces": pa.array(np.diff(reach), pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(plain[s:e]) for s, e in zip(reach, reach[1:], strict=False)], pa.int64()),
                    "same_text": pa.array(
                        [model.text(back[s:e]) == t for s, e, t in zip(place, place[1:], texts, strict=False)], pa.bool_()
                    ),
                }
                if with_ids:
                    out["ids"] = pa.ListArray.from_arrays(pa.array(reach, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_pydict(out)

    return run


def encoded(documents: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Pieces per document: ``doc_id, n_chars, n_pieces, ids_crc32, same_text`` and, if asked, ``ids``.

    ``documents``: ``doc_id`` and ``text``; other columns are ignored.  Ids are
    those of the library.  ``same_text``: decoding the ids gives the text of the
    document again.  It doesn't where normalisation loses something: a U+2581 in
    the text comes back as a blank, and a model whose normaliser folds characters
    or drops blanks doesn't give those again, nor one without byte pieces
    characters it doesn't know.  A NULL or empty text has no pieces; rows keep
    their NULL or repeated ids.
    """
    at_hand(documents.sparkSession)
    schema = "doc_id long, n_chars long, n_pieces long, ids_crc32 long, same_text boolean"
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(
        _encoded(path or piece_model_path(), with_ids), schema + (", ids array<int>" if with_ids else "")
    )


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([None if x is None else model.decode(x) for x in batch.column(1).to_pylist()], pa.string())],
                names=["doc_id", "text"],
            )

    return run


def decoded(encoded_documents: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; NULL ids give a NULL text."""
    at_hand(encoded_documents.sparkSession)
    return encoded_documents.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(
        _decoded(path or piece_model_path()), "doc_id long, text string"
    )
