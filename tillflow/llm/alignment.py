"""Alignment of two tokenizers' tokens over the same bytes by interval coalescing.

All tokens of both tokenizers are intervals of the text's bytes. Sorted by start, a
group ends where the next start reaches the largest end so far; inside a group every
overlapping pair is expanded, and the pairs that end together are links. Texts of a
slice lie one after the other on one axis, so a slice is worked through as arrays.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.encoders import loaded_encoder
from tillflow.llm.text import ragged, release_memory, staged
from tillflow.llm.token_counts import byte_alphabet, text_runs

#: Bytes of text whose link counts go to the exchange together, and characters aligned at once.
BLOCK_BYTES, SLICE_CHARS = 16 << 20, 1 << 18
#: Pieces whose ids a worker keeps; the arrays of a slice need the room.
KEPT_PIECES = 100_000
#: Characters after which a worker gives its freed memory back to the system.
RELEASE_CHARS = 4 << 20
#: A pair of ids as one long.
_SHIFT = 32


class Groups:
    """Coalesced groups of two lists of intervals, each sorted by start and free of overlaps."""

    def __init__(self, starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray):
        start, end = np.concatenate([starts_a, starts_b]), np.concatenate([ends_a, ends_b])
        kind = np.zeros(len(start), np.int8)
        kind[len(starts_a) :] = 1
        order = np.lexsort((kind, start))
        reach = np.maximum.accumulate(end[order]) if len(order) else end
        breaks = np.ones(len(order), bool)
        breaks[1:] = start[order][1:] >= reach[:-1]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(breaks) - 1
        self.a, self.b = group[: len(starts_a)], group[len(starts_a) :]
        self.count = int(breaks.sum())
        #: Where each group starts on the axis.
        self.starts = start[order][breaks]
        self._spans = starts_a, ends_a, starts_b, ends_b

    def overlaps(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (index in a, index in b) that share a byte, by a."""
        starts_a, ends_a, starts_b, ends_b = self._spans
        first = np.searchsorted(ends_b, starts_a, "right")
        n = np.maximum(np.searchsorted(starts_b, ends_a, "left") - first, 0)
        return np.repeat(np.arange(len(starts_a)), n), ragged(first, n)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The overlapping pairs that end together."""
        i, j = self.overlaps()
        same = self._spans[1][i] == self._spans[3][j]
        return i[same], j[same]


class TokenPair:
    """Both tokenizers, their tokens' bytes, and the alignment of a slice of texts."""

    def __init__(self, a_path: str, b_path: str):
        with open(a_path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        alphabet = byte_alphabet()
        if not set(alphabet) <= vocab.keys():
            raise ValueError(f"{a_path}: not all bytes are tokens")
        byte_of = {c: b for b, c in enumerate(alphabet)}
        self.encode_a = loaded_encoder(a_path, plain_special=True, kept=KEPT_PIECES)
        self.length_a = np.zeros(max(vocab.values()) + 1, np.int64)
        self.bytes_a = [b""] * len(self.length_a)
        for token, t in vocab.items():
            if all(c in byte_of for c in token):
                self.bytes_a[t] = bytes(byte_of[c] for c in token)
                self.length_a[t] = len(token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # ids as text, each with what may follow it
        shown = [b"%d%b" % (i, end) for end in (b",", b"|", b";") for i in range(max(len(self.length_a), len(pieces)))]
        self.width = len(shown) // 3
        self.shown_length = np.array([len(x) for x in shown], np.int64)
        #: One row each, NULs after it.
        self.shown = np.array(shown, f"S{-(-self.shown_length.max() // 8) * 8}")

    def align(self, texts: list[str | None]) -> dict:
        """Arrays for a slice of texts: for each text n_a, n_b, n_groups, n_links and groups (bytes);
        for all tokens a, b (ids), and links_a, links_b (indexes into these, in order)."""
        use = [i for i, t in enumerate(texts) if t]
        b_ids = dict(zip(use, self.b.encode([texts[i] for i in use], num_threads=1))) if use else {}
        use = [i for i in use if b"".join(map(self.bytes_b.__getitem__, b_ids[i])) == b" " + texts[i].encode()]
        a_raw = self.encode_a([" " + texts[i] for i in use])
        a = np.frombuffer(b"".join(a_raw), "<u4").astype(np.int64)
        n_a, n_b = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        n_a[use] = [len(r) // 4 for r in a_raw]
        n_b[use] = [len(b_ids[i]) for i in use]
        b = np.fromiter(chain.from_iterable(b_ids[i] for i in use), np.int64, int(n_b.sum()))
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        groups = Groups(ends_a - self.length_a[a], ends_a, ends_b - self.length_b[b], ends_b)
        links_a, links_b = groups.links()
        # both tokenizers end at every text's end, so groups and links stay inside a text
        a_ends, b_ends = np.cumsum(n_a), np.cumsum(n_b)
        upto = np.concatenate([groups.a, [groups.count]])
        group_ends = np.where(a_ends < len(a), upto[np.minimum(a_ends, len(a))], groups.count)
        n_groups = np.diff(group_ends, prepend=0)
        n_links = np.diff(np.searchsorted(links_a, a_ends, "left"), prepend=0)
        return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups": self._shown(a, b, groups, a_ends + b_ends), "a": a, "b": b, "links_a": links_a, "links_b": links_b}

    def _shown(self, a: np.ndarray, b: np.ndarray, groups: Groups, ends: np.ndarray) -> list[bytes]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        last_a = np.diff(groups.a, append=groups.count) > 0
        last_b = np.diff(groups.b, append=groups.count) > 0
        a_before = np.cumsum(np.bincount(groups.a, minlength=groups.count))
        b_before = np.cumsum(np.bincount(groups.b, minlength=groups.count)) - np.bincount(groups.b, minlength=groups.count)
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + b_before[groups.a]] = a + self.width * last_a
        codes[np.arange(len(b)) + a_before[groups.b]] = b + 2 * self.width * last_b
        rows = self.shown[codes].view(np.uint8)
        raw = rows[rows != 0].tobytes()
        places = np.r_[0, np.cumsum(self.shown_length[codes])][ends].tolist()
        return [raw[lo : max(hi - 1, lo)] for lo, hi in zip([0, *places[:-1]], places)]


_LOADED: dict[tuple[str, str], TokenPair] = {}


def _pair(a_path: str, b_path: str) -> TokenPair:
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = TokenPair(a_path, b_path)
    return _LOADED[a_path, b_path]


_DOC = ["n_a", "n_b", "n_groups", "n_links"]


def align_documents(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_a, n_b, n_groups, n_links, groups (text
    ``a1,a2|b1;a3|b2,b3`` of ids), links and overlaps (arrays of pairs of token places in the text).

    Tokenizer A (a byte-level BPE file) reads a space and the text, B (a sentencepiece model)
    the text, to which it adds the space; both without special tokens, whose strings are
    plain text. A null or empty text, and one whose B tokens' bytes are not those of
    space and text, has no tokens: zeros, empty text and arrays. A null id stays null, repeated rows
    are aligned each, an empty table gives an empty result, other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a_path, b_path)
        for batch in batches:
            row = 0
            for texts in text_runs(batch.column(1), SLICE_CHARS):
                got = pair.align(texts)
                a_starts, b_starts = np.cumsum(got["n_a"]) - got["n_a"], np.cumsum(got["n_b"]) - got["n_b"]
                length_a, length_b = pair.length_a[got["a"]], pair.length_b[got["b"]]
                all_a, all_b = Groups(np.cumsum(length_a) - length_a, np.cumsum(length_a), np.cumsum(length_b) - length_b, np.cumsum(length_b)).overlaps()
                lists = []
                for i, j in ((got["links_a"], got["links_b"]), (all_a, all_b)):
                    doc = np.searchsorted(np.cumsum(got["n_a"]), i, "right")
                    places = pa.StructArray.from_arrays([pa.array((i - a_starts[doc]).astype(np.int32)), pa.array((j - b_starts[doc]).astype(np.int32))], ["a", "b"])
                    lists.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(doc, minlength=len(texts)))], pa.int32()), places))
                yield pa.record_batch([batch.column(0).slice(row, len(texts)), *[pa.array(got[c]) for c in _DOC], pa.array([g.decode() for g in got["groups"]]), *lists], ["id", *_DOC, "groups", "links", "overlaps"])
                row += len(texts)

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, {', '.join(f'{c} long' for c in _DOC)}, groups string, links array<struct<a:int,b:int>>, overlaps array<struct<a:int,b:int>>"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def alignment_report(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", id_col: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_a, n_b, n_groups, n_links, n_best (links whose
    pair's corpus-wide count is the highest of their B id, ties included), count_sum (of the
    pairs' counts over links), groups_sha256 ('' without tokens).

    Cases as in ``align_documents``. The links of a block of texts are counted in the task;
    only a block's distinct pairs meet the corpus-wide counts, by exchange, and come back
    to the block's texts; so a pair that all texts share is one row a block, and nothing of the
    counts is broadcast or collected.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a_path, b_path)
        pid, number, size = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[np.ndarray, np.ndarray]] = []  # each slice's distinct pairs and their counts
        freed = 0

        def rows(n: int, kind: bool, values: dict) -> pa.RecordBatch:
            none = {"id": pa.nulls(n, id_arrow), "links": pa.nulls(n, pa.binary()), "groups_sha256": pa.nulls(n, pa.string()), **{c: pa.nulls(n, pa.int64()) for c in [*_DOC, "pair", "n"]}}
            values = none | {"block": pa.array(np.full(n, pid << 32 | number)), "counts": pa.array(np.full(n, kind))} | values
            return pa.record_batch([values[c] for c in names], names)

        def counted() -> pa.RecordBatch:
            pairs, place = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            n = np.zeros(len(pairs), np.int64)
            np.add.at(n, place, np.concatenate([x for _, x in held]))
            held.clear()
            return rows(len(pairs), True, {"pair": pa.array(pairs), "n": pa.array(n)})

        for batch in batches:
            id_arrow, row = batch.schema.field(0).type, 0
            for texts in text_runs(batch.column(1), SLICE_CHARS):
                got = pair.align(texts)
                key = got["a"][got["links_a"]] << _SHIFT | got["b"][got["links_b"]]
                if size >= block_bytes:
                    yield counted()
                    number, size = number + 1, 0
                size += sum(len(t) for t in texts if t)
                held.append(np.unique(key, return_counts=True))
                small = np.empty((len(key), 2), id_bytes)
                small[:, 0], small[:, 1] = key >> _SHIFT, key & ((1 << _SHIFT) - 1)
                raw, ends = memoryview(small.tobytes()), np.cumsum(got["n_links"]) * small.itemsize * 2
                yield rows(len(texts), False, {
                    "id": batch.column(0).slice(row, len(texts)), **{c: pa.array(got[c]) for c in _DOC},
                    "groups_sha256": pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in got["groups"]]),
                    "links": pa.array([raw[lo:hi] for lo, hi in zip([0, *ends[:-1].tolist()], ends.tolist())], pa.binary()),
                })
                row += len(texts)
                freed += sum(len(t) for t in texts if t)
                del got, key, small, raw, ends
                if freed >= RELEASE_CHARS:
                    release_memory()
                    freed = 0
        if held:
            yield counted()
        # workers wait for their next task beside others that run: they keep the tokenizers only
        pair.encode_a.known = {}
        release_memory()

    def looked_up(left: pa.Table, right: pa.Table) -> pa.Table:
        pairs, counts, best = right["pair"].to_numpy(), right["count"].to_numpy(), right["best"].to_numpy()
        order = np.argsort(pairs)
        pairs, counts, best = pairs[order], counts[order], best[order]
        n_best, count_sum = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
        for i, raw in enumerate(left["links"]):
            if len(pairs) and raw.as_buffer().size:
                ab = np.frombuffer(raw.as_buffer(), id_bytes).reshape(-1, 2).astype(np.int64)
                at = np.searchsorted(pairs, ab[:, 0] << _SHIFT | ab[:, 1])
                n_best[i], count_sum[i] = best[at].sum(), counts[at].sum()
        columns = [left["id"], *[left[c] for c in _DOC], pa.array(n_best), pa.array(count_sum), left["groups_sha256"]]
        return pa.table(columns, ["id", *_DOC, "n_best", "count_sum", "groups_sha256"])

    with open(a_path, encoding="utf-8") as f:
        ids_a = max(json.load(f)["model"]["vocab"].values()) + 1
    ids_b = sentencepiece.SentencePieceProcessor(model_file=b_path).vocab_size()
    id_bytes = "<u2" if max(ids_a, ids_b) <= 1 << 16 else "<u4"
    id_type = docs.schema[id_col].dataType.simpleString()
    longs = ", ".join(f"{c} long" for c in _DOC)
    names = ["id", *_DOC, "links", "groups_sha256", "block", "counts", "pair", "n"]
    schema = f"id {id_type}, {longs}, links binary, groups_sha256 string, block long, counts boolean, pair long, n long"
    found = staged(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema), "alignment")
    of_blocks = found.where("counts").select("block", "pair", "n")
    totals = of_blocks.groupBy("pair").agg(F.sum("n").alias("count"))
    b = F.col("pair").bitwiseAND(F.lit((1 << _SHIFT) - 1))
    totals = staged(totals.withColumn("b", b), "alignment")
    most = totals.groupBy("b").agg(F.max("count").alias("most"))
    known = totals.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    lookups = of_blocks.select("block", "pair").join(known, "pair").select(F.col("block").alias("of_block"), "pair", "count", "best")
    texts = found.where("NOT counts").select("block", "id", *_DOC, "links", "groups_sha256")
    out = f"id {id_type}, {longs}, n_best long, count_sum long, groups_sha256 string"
    return texts.groupBy("block").cogroup(lookups.groupBy("of_block")).applyInArrow(looked_up, out).withColumnRenamed("id", id_col)
