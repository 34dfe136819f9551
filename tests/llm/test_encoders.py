"""Ids by whole pieces: looked up once a distinct piece, cut like the library cuts."""

from __future__ import annotations

import random
import sys

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillflow.llm.alignment import TokenPair
from tillflow.llm.encoders import RARE_SPACE, PieceEncoder

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


class _Counted(dict):
    reads = 0

    def get(self, *args):
        self.reads += 1
        return super().get(*args)

    def __getitem__(self, key):
        self.reads += 1
        return super().__getitem__(key)

    def __contains__(self, key):
        self.reads += 1
        return super().__contains__(key)


@pytest.mark.parametrize("file", FILES)
def test_pieces_are_looked_up_once(file):
    encoder = PieceEncoder(public_tokenizers.path(file))
    encoder.known = known = _Counted()
    one, *rest = encoder([" the cat and the hat"] * 500)
    assert one and set(rest) == {one}
    assert known.reads < 50


@pytest.mark.parametrize("file", FILES)
def test_ids_of_odd_texts_are_the_librarys(file):
    assert RARE_SPACE == "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace() and c not in " \t\n\r\x0b\x0c")
    rng = random.Random(3)
    signs = [*"abZ '.,sé1Σ\t\n\r\x0c ", *RARE_SPACE[::5], "'ll", "</s>", "<|endoftext|>", "漢", "😀"]
    texts = [None, "", " ", "\n", "  a", "a  ", *("".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(120))]
    library = Tokenizer.from_file(public_tokenizers.path(file))
    library.no_truncation(), library.no_padding()
    encoder = PieceEncoder(public_tokenizers.path(file), kept=40)
    for _ in range(2):
        got = [np.frombuffer(raw, "<u4").tolist() for raw in encoder(texts)]
        assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert encoder([]) == []


def test_groups_are_written_as_text():
    pair = TokenPair(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    got = pair.align([None, "one cat", "", "and  a hat\n"])
    ends_a, ends_b = np.cumsum(got["n_a"]), np.cumsum(got["n_b"])
    for i, shown in enumerate(got["groups"]):
        sides = [g.split(b"|") for g in shown.split(b";")] if shown else []
        assert len(sides) == got["n_groups"][i]
        assert [int(x) for a, _ in sides for x in a.split(b",")] == got["a"][ends_a[i] - got["n_a"][i] : ends_a[i]].tolist()
        assert [int(x) for _, b in sides for x in b.split(b",")] == got["b"][ends_b[i] - got["n_b"][i] : ends_b[i]].tolist()
