"""Wavelet-matrix files, token alignment and hard negatives against plain versions."""

import hashlib
import io
import os
import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillflow.llm.alignment import Groups, align_documents, alignment_report
from tillflow.llm.encoders import PieceEncoder
from tillflow.llm.hard_negatives import PRIMES, Residues, mine_negatives
from tillflow.llm.wavelet import BLOCK_BITS, MatrixFile, token_documents, token_file_report, token_frequencies, token_occurrences, tokens_at, write_matrix, write_token_files

BYTE, WORD, PIECE = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
PLAIN_BYTE, WORD_LIB = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
PLAIN_BYTE.encode_special_tokens = True
ENCODERS = {"plain": PieceEncoder(BYTE, plain_special=True), "byte": PieceEncoder(BYTE), "word": PieceEncoder(WORD)}
LIBRARIES = {"plain": PLAIN_BYTE, "byte": Tokenizer.from_file(BYTE), "word": WORD_LIB}
POOL = "aAbB \n\t\x1c\x85\xa0 éΣσς Iİß中日 12 ½'s're'LL😀👍🏽\0_- ́ "
ROWS = [(1, "The cat's whiskers"), (7, "The cat's whiskers"), (7, "The cat's whiskers"), (3, None), (4, ""), (None, "a <|endoftext|> b"),
        (5, " \n\t "), (6, "a" * 3000), (8, "".join(random.Random(0).choices("etaoin ", k=30_000))), (9, "low▁line"), (10, "x\0y ½中😀")]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet=POOL + "\U0003d000՘\U00012550\U00013460\U000105c0", max_size=80), st.text(alphabet="abt <|endofx>", max_size=60)))
def test_pieces_like_the_library(text):
    for name, encoder in ENCODERS.items():
        assert np.frombuffer(encoder([text])[0], "<u4").tolist() == LIBRARIES[name].encode(text, add_special_tokens=False).ids, name


def test_kept_pieces_are_bounded():
    encoder = PieceEncoder(WORD, kept=50)
    for lo in range(0, 400, 40):
        texts = [f"word{i} and {'x' * 60}" for i in range(lo, lo + 40)]
        assert [np.frombuffer(r, "<u4").tolist() for r in encoder(texts)] == [WORD_LIB.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(encoder.known) <= 50 and not any(len(p) > 40 for p in encoder.known)


def matrix(ids):
    out = io.BytesIO()
    size = write_matrix(out, ids, pa.record_batch([pa.array([1]), pa.array([len(ids)])], ["id", "n_tokens"]))
    assert size == len(out.getvalue())
    return MatrixFile(out, size)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=60), st.integers(0, 3))
def test_matrix_of_small_lists(ids, wide):
    ids = np.array(ids, np.uint32) * 1000**wide
    m = matrix(ids)
    assert m.ids().tolist() == ids.tolist() and m.access(np.arange(len(ids))).tolist() == ids.tolist()
    for token in {0, 1, 41, *ids.tolist()}:
        want = np.flatnonzero(ids == token)
        assert m.positions(token).tolist() == want.tolist()
        assert m.count(token, 3, 9)[0] == (ids[3:9] == token).sum() and m.count([token, -1, 1 << 40])[1:].tolist() == [0, 0]
    with pytest.raises(IndexError):
        m.access(np.array([len(ids)]))
    with pytest.raises(IndexError):
        m.select(41, np.array([0]))


def test_matrix_over_many_blocks_reads_only_those_it_touches():
    rng = np.random.default_rng(1)
    ids = np.where(rng.random(3 * BLOCK_BITS + 77) < 0.4, 7, rng.zipf(1.3, 3 * BLOCK_BITS + 77) % 49408).astype(np.uint16)
    m = matrix(ids)
    at = rng.integers(0, len(ids), 300)
    assert (m.access(at) == ids[at]).all() and (m.ids() == ids).all()
    for token in (7, 0, 1, 300, 49407):
        assert (m.positions(token) == np.flatnonzero(ids == token)).all()
        assert m.count(token, 1000, BLOCK_BITS + 5)[0] == (ids[1000 : BLOCK_BITS + 5] == token).sum()
    read = matrix(ids)
    sizes, one = [], read._read
    read._read = lambda at, n: sizes.append(n) or one(at, n)
    read.access(np.array([100]))
    assert sum(sizes) < 0.6 * len(read.stream.getvalue())


def word_ids(text):
    return WORD_LIB.encode(text or "", add_special_tokens=False).ids + [2]


def test_files_round_trip(spark, docs_of, workdir):
    rows = [(i, t, "x") for i, t in ROWS]
    files = write_token_files(docs_of(rows, "doc_id long, text string, start string").repartition(3), WORD, f"file://{workdir}/files", shard_tokens=40)
    got = token_documents(files, keep_ids=True).collect()
    in_order = sorted(ROWS, key=lambda r: -1 if r[0] is None else r[0])
    all_ids = [x for _, t in in_order for x in word_ids(t)]
    assert [x for r in sorted(got, key=lambda r: r.start) for x in r.ids] == all_ids
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [i for i, _ in in_order]
    assert all(r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    assert files.count() == 3 and files.agg(F.sum("n_tokens")).first()[0] == len(all_ids)
    assert {os.path.basename(r.path) for r in files.collect()} <= set(os.listdir(f"{workdir}/files"))
    # counting, occurrence lookup and access from the files
    wanted = [2, all_ids[0], 49_000]
    assert dict(map(tuple, token_frequencies(files, wanted).collect())) == {t: all_ids.count(t) for t in wanted}
    places = token_occurrences(files, wanted).collect()
    assert sorted((r.token_id, r.position) for r in places) == sorted((t, p) for p, t in enumerate(all_ids) if t in wanted)
    starts = {r.doc_id: r.start for r in got if r.doc_id != 7}
    assert all(r.position == starts[r.doc_id] + r.place for r in places if r.doc_id != 7)
    positions = spark.createDataFrame([(p,) for p in (0, 5, 5, len(all_ids) - 1, len(all_ids), -1)], "position long")
    assert sorted(map(tuple, tokens_at(files, positions, block=16).collect())) == sorted((p, all_ids[p]) for p in (0, 5, 5, len(all_ids) - 1))


def test_many_rows_of_one_id_are_spread(docs_of):
    got = token_file_report(docs_of([(5, "a b c")] * 200 + [(6, None)]), WORD).collect()
    assert sorted(r.start for r in got) == [4 * i for i in range(200)] + [800]


def test_groups_of_any_intervals():
    rng = random.Random(3)
    for _ in range(200):
        cuts = [sorted(rng.sample(range(1, 30), rng.randint(0, 12))) for _ in range(2)]
        (sa, ea), (sb, eb) = ((np.array([0, *c]), np.array([*c, 30])) for c in cuts)
        groups = Groups(sa, ea, sb, eb)
        common = sorted(set(ea.tolist()) & set(eb.tolist()))
        assert groups.count == len(common) and groups.starts.tolist() == [0, *common[:-1]]
        want = [(i, j) for i in range(len(sa)) for j in range(len(sb)) if sa[i] < eb[j] and sb[j] < ea[i]]
        assert list(zip(*(x.tolist() for x in groups.overlaps()))) == want
        assert [int(ea[i]) for i in groups.links()[0]] == common


def test_alignment_like_brute_force(docs_of):
    rows = [(i, t, 1) for i, t in ROWS]
    got = alignment_report(docs_of(rows, "doc_id long, text string, block int").repartition(3), BYTE, PIECE, block_bytes=500).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute.alignment(ROWS), key=repr)
    whole = {r.groups_sha256 for r in got}
    for r in align_documents(docs_of(rows, "doc_id long, text string, block int"), BYTE, PIECE).collect():
        assert (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") in whole
        assert len(r.links) == r.n_links == r.n_groups and len(r.overlaps) == r.n_a + r.n_b - r.n_groups
        assert set(map(tuple, r.links)) <= set(map(tuple, r.overlaps))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=POOL + "▁<0x1>", max_size=60))
def test_aligned_bytes(text):
    from tillflow.llm.alignment import _pair

    got = _pair(BYTE, PIECE).align([text, None, "the end"])
    lib_b = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    if got["n_a"][0]:
        assert got["a"][: got["n_a"][0]].tolist() == PLAIN_BYTE.encode(" " + text, add_special_tokens=False).ids
        assert got["b"][: got["n_b"][0]].tolist() == lib_b.encode(text)
    assert got["n_a"][1] == 0 and got["groups"][2] == brute_groups("the end")


def brute_groups(text):
    a, b = PLAIN_BYTE.encode(" " + text, add_special_tokens=False).ids, sentencepiece.SentencePieceProcessor(model_file=PIECE).encode(text)
    assert len(a) == len(b)
    return ";".join(f"{x}|{y}" for x, y in zip(a, b)).encode()


def test_residue_products_are_exact():
    rng = np.random.default_rng(5)
    for top, width in ((1, 1), (300, 64), (40_000, 2100), (1 << 27, 3)):
        a, b = (rng.integers(-top, top + 1, (n, width)) for n in (7, 9))
        a[0], b[0], b[1] = top, top, -top  # the largest scores of both signs
        residues = Residues(width * top * top)
        assert np.prod([float(p) for p in residues.primes]) > 2.0 * width * top * top
        assert (residues.product(residues.split(a), residues.split(b)) == a @ b.T).all()
    assert all(all(p % d for d in range(2, 16)) for p in PRIMES)
    with pytest.raises(ValueError):
        Residues(1 << 62)


def plain_negatives(rows, scale=256):
    use = [(k, i, label, np.floor(np.array(v, np.float64) * scale)) for k, (i, label, v) in enumerate(rows)
           if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    score = lambda a, b: int(sum(x * y for x, y in zip(a, b)))
    out = []
    for k, i, label, v in use:
        if i % 100:
            continue
        others = sorted((-score(v, w), j, m, other) for m, j, other, w in use if m != k)
        for p, j, _, _ in [x for x in others if x[3] == label][:5]:
            fit = [(s, n) for s, n, _, other in others if other != label and 30 * -p <= 100 * -s <= 90 * -p][:10]
            out += [(i, j, rank, n, -p, -s) for rank, (s, n) in enumerate(fit, 1)]
    return sorted(out)


VECTORS = "vec_id long, label int, embedding array<float>, row string"


@pytest.mark.parametrize("blocks", [(8192, 16384), (13, 2)])
def test_hard_negatives_like_brute_force(docs_of, blocks):
    rng = np.random.default_rng(2)
    rows = [(i, int(rng.integers(0, 4)), np.round(rng.normal(size=6), 1).tolist()) for i in range(0, 700, 3)]
    rows += [(300, 1, [0.5] * 6)] * 30 + [(k, 2, [0.5] * 6) for k in range(1000, 1040)]  # repeated rows, ties
    rows += [(None, 1, [1.0]), (100, None, [1.0]), (100, 1, None), (100, 1, [float("nan")]), (100, 1, [float("inf")]), (100, 1, [None]), (200, 1, []), (400, 9, [1.0, 1.0])]
    got = mine_negatives(docs_of([(*r, "x") for r in rows], VECTORS), F.col("vec_id") % 100 == 0, row_block=blocks[0], anchor_block=blocks[1]).collect()
    assert sorted(map(tuple, got)) == plain_negatives(rows)


def test_no_rows(docs_of):
    assert token_file_report(docs_of([]), WORD).collect() == []
    assert alignment_report(docs_of([]), BYTE, PIECE).collect() == []
    assert mine_negatives(docs_of([], VECTORS), F.col("vec_id") % 100 == 0).collect() == []
    assert mine_negatives(docs_of([(1, 1, [1.0], "x")], VECTORS), F.col("vec_id") % 100 == 0).collect() == []
    assert mine_negatives(docs_of([(100, 1, [1.0], "x")], VECTORS), F.col("vec_id") % 100 == 0).collect() == []
