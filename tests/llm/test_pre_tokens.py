"""Ids by array operations are those of the tokenizer library."""

import numpy as np
import pytest
from ledgerloom.llm.tokenizing import encode_texts, pre_tokenizer, tokenizer_path
from tokenizers import Tokenizer

ALL = [chr(c) for c in range(256)]
CASES = [
    "",
    " ",
    "\n",
    " \n a",
    "it's I'll we've'd 'tis ''s 's's ' 're'll'x don'tt 'S 'LL",
    "a  b\t c \n\nd  ",
    "x\x1b[31mred\x1b[0m y\x7f",
    "12 3²¾ a1b2",
    "<|endoftext|> in <|startoftext|>",
    "œuvre “quoted” 漢字 😀",
    "é Å",
    *(f"a{c}b {c} {c}{c}'s{c} {c}'s\n{c}x {c}1" for c in ALL),
    "".join(ALL),
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_the_librarys(name):
    path = tokenizer_path(name)
    assert pre_tokenizer(path).split is not None
    lib = Tokenizer.from_file(path)
    rng = np.random.default_rng(1)
    few = [*"ab s'tre  \n\t.1²é", "'ll", "<|endoftext|>"]
    texts = CASES + ["".join(rng.choice(x, int(rng.integers(1, 60)))) for x in (ALL, few) for _ in range(1500)]
    ids, counts = encode_texts(path, [t.encode() for t in texts])
    ends = np.cumsum(counts)
    for t, e, n in zip(texts, ends, counts, strict=True):
        assert ids[e - n : e].tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)
    assert encode_texts(path, [])[0].tolist() == []
