"""Token counts and BPE codes against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillflow.llm.bpe_codec import TextCodec, WordBpe, encode_texts
from tillflow.llm.token_counts import MergeTable, TokenCounter, count_tokens

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
BYTE_LIB, WORD_LIB = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
COUNTER = TokenCounter(MergeTable(BYTE))
CODEC = TextCodec(WordBpe(WORD))
POOL = "aAbB \n\t\x1c\x85 éΣσς Iİß中日 12 ½'s're'LL😀👍🏽\0_-"
ROWS = [(1, "The cat's whiskers"), (1, "The cat's whiskers"), (2, None), (3, ""), (None, "a <|endoftext|> b<|startoftext|>"),
        (4, " \n\t "), (5, "a" * 5000), (6, "".join(random.Random(0).choice("etaoin") for _ in range(30_000)))]


def lib_count(text):
    return len(BYTE_LIB.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet=POOL + "\U0003d000\u0558\U00012550\U00013460\U000105c0", max_size=80), st.text(alphabet="abt<|endofx>", max_size=60)))
def test_texts_like_the_library(text):
    assert COUNTER.counts([text]) == [lib_count(text)]
    ids = WORD_LIB.encode(text, add_special_tokens=False).ids
    raw = np.frombuffer(CODEC.ids([text])[0], "<u4")
    assert raw.tolist() == ids
    assert CODEC.bpe.decode(raw).decode() == WORD_LIB.decode(ids, skip_special_tokens=False)


def test_overlapping_pairs_merge_from_the_left():
    for n in range(1, 40):
        assert COUNTER.counts(["o" * n]) == [lib_count("o" * n)]


def test_count_rows(docs_of):
    rows = [(i, t, "x") for i, t in ROWS]
    got = count_tokens(docs_of(rows, "doc_id long, text string, n_tokens string"), BYTE, limit=3).collect()
    want = [(i, len((t or "").encode()), lib_count(t), lib_count(t) > 3) for i, t in ROWS]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_encode_rows(docs_of):
    rows = [(i, t, "x") for i, t in ROWS]
    got = encode_texts(docs_of(rows, "doc_id long, text string, id string"), WORD, keep_ids=True).collect()
    want = []
    for i, t in ROWS:
        ids = WORD_LIB.encode(t or "", add_special_tokens=False).ids
        text = WORD_LIB.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), ids, text))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_empty_tables(docs_of):
    empty = docs_of([])
    assert count_tokens(empty, BYTE).collect() == []
    assert encode_texts(empty, WORD).collect() == []


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_files_of_the_other_kind_are_refused(path):
    with pytest.raises((ValueError, KeyError, TypeError)):
        (MergeTable if path == WORD else WordBpe)(path)


def test_plain_words_are_not_searched_for_newer_letters_and_pairs_share_places(monkeypatch):
    """New words cost no search through the long class of letters, and pairs that fall on one
    place of the small table are told apart."""
    from tillflow.llm import bpe_codec

    path = public_tokenizers.path("word_bpe_49k.json")
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefghijé中"), int(rng.integers(1, 12)))) for _ in range(400)]
    want = bpe_codec.TextCodec(bpe_codec.WordBpe(path)).ids([" ".join(words), "\U00013460x y\U000105c0"])
    monkeypatch.setattr(bpe_codec, "PAIR_PLACES", 4)
    bpe = bpe_codec.WordBpe(path)
    calls, newer = [], bpe.splitter.newer
    bpe.splitter.newer = lambda w: calls.append(w) or newer(w)
    codec = bpe_codec.TextCodec(bpe)
    assert len(bpe.seen_pairs) == 4
    assert codec.ids(["été " + " ".join(w.replace("中", "") for w in words)]) and not calls
    assert codec.ids([" ".join(words), "\U00013460x y\U000105c0"]) == want
