"""Removal of repeated byte strings, by common prefixes from a Burrows-Wheeler transform.

Every string of ``length`` bytes has a smallest hash among its GRAM-byte parts (of
equal ones the last), and equal strings have it at the same offset. Neighbouring
strings of a text with the same smallest part form a run, in which no two strings
are equal; runs with one smallest hash form a group, so equal strings always meet in
one group, and every string of the corpus stands in one run. Runs of a group that are
equal as a whole are repeated as a whole. Where a group holds different
runs, their texts are put together in blocks; a block's Burrows-Wheeler transform is
extended backward, breadth first: level by level the borders between suffixes with a
common prefix of 0, 1, 2, ... bytes become known, and at ``length`` the expansion
stops: suffixes without a border between them share their first ``length`` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.text import SLICE_BYTES, inverse_powers, list_column, mix, prefix_hashes, release_memory, sliding_min, small_side, span_hashes, staged, text_key, text_slices, utf8

LENGTH = 200
GRAM = 32
BLOCK_BYTES = 1 << 20
#: Low bits of a hash that hold its place in a slice (a slice has at most 2 * SLICE_BYTES bytes).
PLACE = np.uint64((1 << 23) - 1)


# --- runs of strings with one smallest hash --------------------------------------------------


def text_runs_of(data: np.ndarray, offs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of the texts in ``data``: text, first string's start in it, number of
    strings, group (their smallest hash) and hash of the run's bytes."""
    empty = np.empty(0, np.int64)
    n = len(data) - length + 1
    if n <= 0:
        return empty, empty, empty, np.empty(0, np.uint64), np.empty(0, np.uint64)
    gram = min(GRAM, length)
    sums = prefix_hashes(data)
    hashes = sums[gram:] - sums[: len(data) - gram + 1]
    hashes *= inverse_powers(len(hashes))
    mix(hashes)
    # the place of the smallest hash of each string: its high bits, then the later place
    placed = (hashes & ~PLACE) | (PLACE - np.arange(len(hashes), dtype=np.uint64))
    least = sliding_min(placed, length - gram + 1)
    # strings that lie in one text, in text order
    lengths = np.diff(offs)
    starts = offs[:-1][lengths >= length]
    last = offs[1:][lengths >= length] - length  # last string start of each such text
    if not len(starts):
        return empty, empty, empty, np.empty(0, np.uint64), np.empty(0, np.uint64)
    change = np.ones(n, bool)
    change[1:] = least[1:] != least[:-1]
    change[starts] = True
    valid = np.zeros(n + 1, np.int8)
    np.add.at(valid, starts, 1)
    np.add.at(valid, last + 1, -1)
    valid = np.cumsum(valid[:n]) > 0
    begin = np.flatnonzero(change & valid)
    after = np.append(begin[1:], n)
    owner = np.searchsorted(offs, begin, "right") - 1
    end = np.minimum(after, offs[owner + 1] - length + 1)
    group = hashes[(PLACE - (least[begin] & PLACE)).astype(np.int64)]
    return owner, begin - offs[owner], end - begin, group, span_hashes(sums, begin, end + length - 1)


def long_slices(column: pa.Array, length: int) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes skipped of the first row, bytes, offsets): slices as
    ``text_slices`` gives them, a longer text in overlapping parts of its own."""
    for lo, hi, data, offs in text_slices(column):
        if len(data) <= 2 * SLICE_BYTES:
            yield lo, hi, 0, data, offs
            continue
        for start in range(0, len(data), SLICE_BYTES):  # one text; a string belongs to the part it starts in
            part = data[start : start + SLICE_BYTES + length - 1]
            if len(part) >= length:
                yield lo, hi, start, part, np.array([0, len(part)])


def run_rows(docs: DataFrame, length: int) -> DataFrame:
    """Rows (id, tk, start, strings, g, d) of a table (id, tk, text): each text's runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, skipped, data, offs in long_slices(batch.column(2), length):
                owner, start, strings, group, whole = text_runs_of(data, offs, length)
                fields = [pa.array(start + skipped), pa.array(strings), pa.array(group.view(np.int64)), pa.array(whole.view(np.int64))]
                runs = pa.StructArray.from_arrays(fields, ["start", "strings", "g", "d"])
                counts = np.bincount(owner, minlength=hi - lo)
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), list_column(runs, counts)], ["id", "tk", "runs"])
        release_memory()  # the worker waits beside others that run

    kind = docs.schema["id"].dataType.simpleString()
    rows = docs.mapInArrow(run, f"id {kind}, tk long, runs array<struct<start:long,strings:long,g:long,d:long>>")
    return rows.select("id", "tk", F.inline("runs"))


# --- the Burrows-Wheeler transform of a block ------------------------------------------------


def sorted_rotations(data: np.ndarray, depth: int) -> np.ndarray:
    """Start positions of the block's rotations, sorted by their first ``depth`` bytes at least."""
    n = len(data)
    twice = np.concatenate([data, np.resize(data, 8)])
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | twice[i : i + n].astype(np.uint64)
    size = 8
    while True:
        order = np.argsort(key, kind="stable" if size == 8 else None)
        ordered = key[order]
        fresh = np.ones(n, bool)
        fresh[1:] = ordered[1:] != ordered[:-1]
        if size >= depth or fresh.all():
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh) - 1
        key = rank * n + np.roll(rank, -size % n)
        size *= 2


def borders_below(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether the sorted rotations i - 1 and i have a common prefix shorter than
    ``length``, for i from 0 to n, by backward extension from the empty string."""
    n = len(data)
    bwt = data[order - 1]  # the byte before each rotation
    by_byte = np.argsort(bwt, kind="stable")
    step = np.empty(n, np.int64)  # where the rotation that starts one byte earlier stands
    step[by_byte] = np.arange(n)
    same = bwt[by_byte][1:] == bwt[by_byte][:-1]
    following = np.full(n, n)  # the next row with the same byte before it
    following[by_byte[:-1][same]] = by_byte[1:][same]
    preceding = np.full(n, -1)
    preceding[by_byte[1:][same]] = by_byte[:-1][same]
    border = np.zeros(n + 1, bool)
    border[0] = border[n] = True
    first, last = np.array([0]), np.array([n])  # intervals of strings of the current level
    for _ in range(length):
        sizes = last - first
        offset = np.cumsum(sizes) - sizes
        rows = np.arange(sizes.sum()) + np.repeat(first - offset, sizes)
        low, high = np.repeat(first, sizes), np.repeat(last, sizes)
        # each byte's rows in an interval become one interval of the next level
        new_first = np.sort(step[rows[preceding[rows] < low]])
        new_last = np.sort(step[rows[following[rows] >= high]] + 1)
        fresh = ~border[new_last]
        first, last = new_first[fresh], new_last[fresh]
        if not len(first):
            break
        border[last] = True
    return border


def repeated_strings(data: np.ndarray, valid: np.ndarray, length: int) -> np.ndarray:
    """Which ``valid`` positions start a ``length``-byte string that another valid position starts too."""
    order = sorted_rotations(data, length + 1)
    border = borders_below(data, order, length)
    block = np.cumsum(border[:-1]) - 1
    counts = np.bincount(block, weights=valid[order])
    found = np.zeros(len(data), bool)
    found[order] = counts[block] >= 2
    return found & valid


def block_spans(group_rows: list[tuple], length: int) -> Iterator[tuple]:
    """(id, tk, start, end) of the bytes covered by repeated strings, for the rows
    (id, tk, start, alone, bytes) of whole groups; only rows ``alone`` in their class report."""
    data = np.frombuffer(b"".join(r[4] for r in group_rows), np.uint8)
    sizes = np.array([len(r[4]) for r in group_rows])
    offs = np.cumsum(sizes) - sizes
    valid = np.ones(len(data), bool)
    for j in range(1, length):
        valid[np.maximum(offs + sizes - j, offs)] = False
    found = repeated_strings(data, valid, length)
    for (id_, tk, start, alone, _), at, size in zip(group_rows, offs.tolist(), sizes.tolist()):
        hits = np.flatnonzero(found[at : at + size]) if alone else ()
        if len(hits):
            cut = np.flatnonzero(np.diff(hits) > length) + 1
            for part in np.split(hits, cut):
                yield id_, tk, start + int(part[0]), start + int(part[-1]) + length


# --- the operator ----------------------------------------------------------------------------


def repeated_spans(docs: DataFrame, length: int, block_bytes: int) -> DataFrame:
    """Rows (id, tk, start, end): spans of repeated bytes of a table (id, tk, text)."""
    runs = staged(run_rows(docs, length), "repeat_runs")
    kinds = runs.groupBy("g", "d").agg(F.count("*").alias("copies"), F.min(F.struct("id", "tk", "start", "strings")).alias("r"))
    size = F.col("r.strings") + length - 1
    groups = kinds.groupBy("g").agg(F.sum("copies").alias("n"), F.count("*").alias("kinds"), F.min("copies").alias("least"), F.sum(size).alias("bytes")).filter("n > 1")
    kinds = staged(kinds.join(groups.drop("n"), "g"), "repeat_kinds")
    whole = kinds.filter("copies > 1").select("g", "d")
    spans = runs.join(whole, ["g", "d"]).select("id", "tk", "start", (F.col("start") + F.col("strings") + length - 1).alias("end"))
    mixed = kinds.filter("kinds > 1 and least = 1").select("g", (F.col("copies") == 1).alias("alone"), "r.*", (F.col("bytes") > block_bytes).alias("wide"))
    pieces = staged(run_texts(docs, mixed, length), "repeat_pieces")
    narrow = pieces.filter(~F.col("wide")).select("g", "id", "tk", "start", "alone", "piece")
    found = narrow.repartition("g").sortWithinPartitions("g").mapInArrow(_in_blocks(length, block_bytes), spans.schema)
    return staged(spans.unionByName(found).unionByName(wide_spans(pieces.filter("wide"), length)), "repeat_spans")


def run_texts(docs: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """``runs`` (g, id, tk, start, strings, alone, wide) with their bytes, ``piece``."""
    per_text = staged(runs.groupBy("id", "tk").agg(F.collect_list(F.struct("g", "start", "strings", "alone", "wide")).alias("runs")), "repeat_wanted")
    wanted = per_text.withColumnsRenamed({"id": "wid", "tk": "wtk"})
    ids = small_side(wanted.select("wid", "wtk"), 32)
    same = lambda a, b: a["id"].eqNullSafe(b["wid"]) & (a["tk"] == b["wtk"])
    texts = docs.join(ids, same(docs, ids), "left_semi").dropDuplicates(["id", "tk"])
    rows = texts.join(wanted, same(texts, wanted)).select("id", "tk", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = utf8(batch.column(2))
            lists = batch.column(3)
            counts = lists.value_lengths().to_numpy()
            fields = lists.flatten()
            names = ["g", "start", "strings", "alone", "wide"]
            g, start, strings, alone, wide = (fields.field(i) for i in range(5))
            base = np.repeat(offs[:-1], counts) + start.to_numpy()
            ends = base + strings.to_numpy() + length - 1
            pieces = pa.array([data[a:b].tobytes() for a, b in zip(base, ends)], pa.binary())
            row = pa.array(np.repeat(np.arange(len(counts)), counts))
            yield pa.record_batch([g, batch.column(0).take(row), batch.column(1).take(row), start, alone, wide, pieces], ["g", "id", "tk", *names[1:2], "alone", "wide", "piece"])

    kind = docs.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"g long, id {kind}, tk long, start long, alone boolean, wide boolean, piece binary")


def _in_blocks(length: int, block_bytes: int):
    """Whole groups, in the order of ``g``, in blocks of about ``block_bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None

        def spans() -> pa.RecordBatch:
            out = list(zip(*block_spans(held, length))) or [(), (), (), ()]
            kinds = [id_type, pa.int64(), pa.int64(), pa.int64()]
            return pa.record_batch([pa.array(v, k) for v, k in zip(out, kinds)], ["id", "tk", "start", "end"])

        for batch in batches:
            id_type = batch.column(1).type
            for g, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if g != last and size >= block_bytes:
                    yield spans()
                    held, size = [], 0
                last = g
                held.append(tuple(row))
                size += len(row[-1])
        if held:
            yield spans()
        held.clear()
        release_memory()

    return run


def wide_spans(pieces: DataFrame, length: int) -> DataFrame:
    """The same spans for groups too large for one block (many variants of one text):
    their strings' 128-bit digests are counted by shuffle, so no task holds a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for id_, tk, start, alone, piece in zip(*(batch.column(i).to_pylist() for i in range(5))):
                n = len(piece) - length + 1
                digests = [hashlib.blake2b(piece[i : i + length], digest_size=16).digest() for i in range(n)]
                yield pa.record_batch([pa.array([id_] * n, batch.column(0).type), pa.array([tk] * n, pa.int64()), pa.array(np.arange(start, start + n)), pa.array([alone] * n), pa.array(digests, pa.binary())], ["id", "tk", "at", "alone", "digest"])

    kind = pieces.schema["id"].dataType.simpleString()
    strings = pieces.select("id", "tk", "start", "alone", "piece").mapInArrow(run, f"id {kind}, tk long, at long, alone boolean, digest binary")
    repeated = strings.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    hits = strings.filter("alone").join(repeated, "digest").select("id", "tk", "at")
    gap = F.col("at") - F.lag("at").over(Window.partitionBy("id", "tk").orderBy("at"))
    part = F.sum((F.coalesce(gap, F.lit(0)) > length).cast("int")).over(Window.partitionBy("id", "tk").orderBy("at"))
    parts = hits.withColumn("part", part).groupBy("id", "tk", "part")
    return parts.agg(F.min("at").alias("start"), (F.max("at") + length).alias("end")).select("id", "tk", "start", "end")


def cut_rows(docs: DataFrame, length: int, block_bytes: int, keep_text: bool) -> DataFrame:
    """(id, tk, text, spans) of the texts with repeated bytes, cut: (id, tk, n_bytes,
    n_removed, n_spans, kept_sha256) and with ``keep_text`` the remaining text."""
    spans = repeated_spans(docs, length, block_bytes)
    listed = staged(spans.groupBy("id", "tk").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "repeat_texts")
    listed = listed.withColumnsRenamed({"id": "wid", "tk": "wtk"})
    ids = small_side(listed.select("wid", "wtk"), 32)
    same = lambda a, b: a["id"].eqNullSafe(b["wid"]) & (a["tk"] == b["wtk"])
    texts = docs.join(ids, same(docs, ids), "left_semi").dropDuplicates(["id", "tk"])
    rows = texts.join(listed, same(texts, listed)).select("id", "tk", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(2), batch.column(3)):
                raw, kept, merged, at = (text.as_py() or "").encode(), [], [], 0
                for start, end in sorted((s["start"], s["end"]) for s in spans.as_py()):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(end, merged[-1][1])
                    else:
                        merged.append([start, end])
                for start, end in merged:
                    kept.append(raw[at:start])
                    at = end
                rest = b"".join([*kept, raw[at:]])
                row = (len(raw), len(raw) - len(rest), len(merged), hashlib.sha256(rest).hexdigest())
                # a border may fall inside a character; its loose bytes are dropped from the text
                out.append(row + ((rest.decode(errors="ignore"),) if keep_text else ()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = [pa.array([r[i] for r in out], kinds[i]) for i in range(5 if keep_text else 4)]
            yield pa.record_batch([batch.column(0), batch.column(1), *columns], ["id", "tk", "n_bytes", "n_removed", "n_spans", "kept_sha256", "rest"][: 2 + len(columns)])

    kind = docs.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, tk long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", rest string" if keep_text else ""))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tk"), F.col(text_col).alias("text"))


def repeat_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_bytes, n_removed, n_spans (maximal removed
    runs) and kept_sha256 (of the remaining bytes), after removing every byte covered by
    a ``length``-byte string that starts anywhere else in the table too.

    Null and empty texts have no bytes; shorter texts lose none; repeated rows are
    copies of each other and lose all; a null id is an id like others. An empty
    table gives an empty result, other columns are ignored.
    """
    rows = keyed(docs, id_col, text_col)
    cut = cut_rows(rows, length, block_bytes, False).select(F.col("id").alias("wid"), F.col("tk").alias("wtk"), F.col("n_removed").alias("r"), F.col("n_spans").alias("s"), F.col("kept_sha256").alias("h"))
    whole = rows.select("id", "tk", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    joined = whole.join(cut, whole["id"].eqNullSafe(cut["wid"]) & (whole["tk"] == cut["wtk"]), "left")
    zero = lambda c, name: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(name)
    return joined.select(F.col("id").alias(id_col), "n_bytes", zero("r", "n_removed"), zero("s", "n_spans"), F.coalesce("h", "sha").alias("kept_sha256"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = None, length: int = LENGTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All rows and columns of ``docs``, their texts without the repeated bytes."""
    cut = cut_rows(keyed(docs, id_col, text_col), length, block_bytes, True).select(F.struct("id", "tk").alias("cut_key"), F.col("rest").alias("cut_rest"))
    key = F.struct(docs[id_col].alias("id"), text_key(docs[text_col]).alias("tk"))
    joined = docs.join(cut, key.eqNullSafe(cut["cut_key"]), "left")
    text = F.coalesce(cut["cut_rest"], docs[text_col])
    columns = [text.alias(c) if c == text_col else F.length(text).cast(docs.schema[c].dataType).alias(c) if c == chars_col else docs[c] for c in docs.columns]
    return joined.select(*columns)
