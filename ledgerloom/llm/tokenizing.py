"""Public BPE files, applied through the library once per distinct stretch of text."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

from ledgerloom.llm.common import Codes, gather, spans, worker_cache
from ledgerloom.llm.latin import WORDS, split_bytes, split_words


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: The normalizer for which lower-casing is all that happens to a text of Latin-1 letters (fixed values): such texts
#: are composed already, and white space is dropped by the split.
_FOLDS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]


class PreTokenizer:
    """Pre-tokens of a text and their pieces, exactly as the library gives them without added special tokens.

    A pre-token is a ``str`` in the file's byte-level spelling (a special string
    has a NUL before it), or ``bytes`` of Latin-1 for texts within Latin-1.
    """

    SPECIAL = "\0"

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        self.vocabulary = spec["model"]["vocab"]
        cutter = spec.get("pre_tokenizer") or {}
        parts = cutter.get("pretokenizers", [])
        self.split = None
        if (
            (spec.get("normalizer") or {}).get("normalizers") == _FOLDS
            and [x["type"] for x in parts] == ["Split", "ByteLevel"]
            and parts[0]["pattern"] == {"Regex": WORDS}
            and not parts[1]["add_prefix_space"]
        ):
            self.split = split_words
        elif (
            spec.get("normalizer") is None
            and cutter.get("type") == "ByteLevel"
            and cutter.get("use_regex")
            and not cutter.get("add_prefix_space")
        ):
            self.split = split_bytes
        self.marks = [name.encode() for name in names]
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelling = {chr(b): spell.pre_tokenize_str(chr(b))[0][0] for b in range(256)}

    def pre(self, text: str) -> list[str]:
        """The pre-tokens through the library."""
        out: list[str] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(self.SPECIAL + part)
            elif part:
                if self.tokenizer.normalizer is not None:
                    part = self.tokenizer.normalizer.normalize_str(part)
                if self.tokenizer.pre_tokenizer is not None:
                    out += [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]
                else:
                    out.append(part)
        return out

    def latin(self, text: bytes) -> bytes | None:
        """The text in Latin-1, if it can be cut there; None if the library has to cut it."""
        if self.split is None or any(m in text for m in self.marks):
            return None
        if text.isascii():
            return text
        try:
            return text.decode("utf-8", "replace").encode("latin-1")
        except UnicodeEncodeError:
            return None

    def pre_tokens(self, texts: list[bytes]) -> tuple[list[bytes | str], np.ndarray, np.ndarray]:
        """Pre-tokens of texts in UTF-8: each different one once, its number at every place, and places per text."""
        plain = [self.latin(t) for t in texts]
        quick = np.array([p is not None for p in plain], bool)
        counts = np.zeros(len(texts), np.int64)
        names: list[bytes | str] = []
        held = np.zeros(0, np.int64)
        if quick.any():
            found, counts[quick] = self.split([p for p in plain if p is not None])
            distinct = found.dictionary_encode()
            names = distinct.dictionary.to_pylist()
            held = distinct.indices.to_numpy().astype(np.int64)
        if not quick.all():
            known: dict[str, int] = {}
            slow = []
            for t in (t for t, q in zip(texts, quick, strict=True) if not q):
                parts = self.pre(t.decode("utf-8", "replace"))
                slow.append([known.setdefault(p, len(names) + len(known)) for p in parts])
            names += known
            counts[~quick] = list(map(len, slow))
            both = np.concatenate([held, *(np.array(x, np.int64) for x in slow)])
            starts = np.zeros(len(texts), np.int64)
            starts[quick] = spans(counts[quick])[:-1]
            starts[~quick] = len(held) + spans(counts[~quick])[:-1]
            held = gather(both, starts, counts)
        return names, held, counts

    def spelled(self, token: bytes | str) -> str:
        """The same pre-token in the byte-level spelling."""
        if isinstance(token, str):
            return token
        word = token.decode("latin-1")
        # Control characters have a spelling of their own, as a blank has.
        if word.isascii() and word.isprintable() and " " not in word:
            return word
        return "".join(map(self.spelling.__getitem__, word))

    def ids(self, token: bytes | str) -> list[int]:
        word = self.spelled(token)
        if word[:1] == self.SPECIAL and word[1:] in self.special:
            return [self.special[word[1:]]]
        return [t.id for t in self.tokenizer.model.tokenize(word)]

    def pieces(self, token: bytes | str) -> int:
        """The number of pieces of one pre-token."""
        word = self.spelled(token)
        if word[:1] == self.SPECIAL and word[1:] in self.special:
            return 1
        return len(self.tokenizer.model.tokenize(word))

    def known(self) -> dict[str, int]:
        """Counts of the pre-tokens that are a piece of the vocabulary: as many as the file has, whatever the data."""
        end = self.suffix
        whole = (p[: len(p) - len(end)] for p in self.vocabulary if p.endswith(end) and len(p) > len(end))
        return {p: self.pieces(p) for p in whole if p[:1] != self.SPECIAL}


@lru_cache(maxsize=2)
def pre_tokenizer(path: str) -> PreTokenizer:
    """One per Python worker."""
    return PreTokenizer(path)


def id_codes(path: str) -> Codes:
    """Ids of the pre-tokens this Python worker has met, kept from task to task."""
    return worker_cache("ids", path, lambda: Codes(pre_tokenizer(path).ids, most=600_000))


def encode_texts(path: str, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts (UTF-8) one after another, and how many each has; no special tokens are added."""
    tok, codes = pre_tokenizer(path), id_codes(path)
    codes.trim()
    names, held, counts = tok.pre_tokens(texts)
    own = np.fromiter(map(codes.__getitem__, names), np.int64, len(names))
    ids, sizes = codes.runs(own[held])
    return ids, np.diff(spans(sizes)[spans(counts)])
