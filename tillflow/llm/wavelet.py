"""Token ids in wavelet-matrix files: one compressed file a shard, random access inside.

A file holds the ids of a run of documents as bit-planes, highest bit first; each
plane is the bit of every id in the order that the planes above leave (ids with bit 0
first, then those with bit 1, each in their order before). With the number of ones
before every block of a plane, the id at a position (access), the occurrences of an
id in a range (count) and the place of its k-th occurrence (select) each follow from
one step a plane, reading only the blocks they touch.

File format, little-endian: 8 bytes ``WVMATRX1``; the blocks of every plane, each
``BLOCK_BITS`` bits (first bit in the highest place), as zstd data where that is
shorter; for every plane its directory: the blocks' lengths (u32) and the ones before
them (u64); the documents as an Arrow stream (id, number of tokens); a JSON footer
with the places of these; the footer's length (u32); 8 bytes ``WVMATRX1``.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.encoders import loaded_encoder
from tillflow.llm.text import staged
from tillflow.llm.token_counts import text_runs
from tillflow.runtime import scratch_path

MAGIC = b"WVMATRX1"
BLOCK_BITS = 1 << 16
SHARD_TOKENS = 1 << 22
#: Files that one task reads at most, when there are more than ``READ_TASKS``.
READ_TASKS = 20_000


# -- the file ---------------------------------------------------------------

def write_matrix(out, ids: np.ndarray, docs: pa.RecordBatch) -> int:
    """Write one file to an open binary stream; returns its length. ``docs`` has the columns
    id and n_tokens, which add up to the ids."""
    levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    at = len(MAGIC)
    out.write(MAGIC)
    planes, directory = [], []
    rest, squeeze = ids, zstandard.ZstdCompressor(level=1).compress
    for level in range(levels - 1, -1, -1):
        ones = (rest & rest.dtype.type(1 << level)).astype(bool)
        packed = np.packbits(ones)
        step = BLOCK_BITS // 8
        blocks = [packed[lo : lo + step].tobytes() for lo in range(0, len(packed), step)]
        stored = [min(b, squeeze(b), key=len) for b in blocks]  # as it is, unless shorter
        pad = np.zeros(len(blocks) * BLOCK_BITS, bool)
        pad[: len(ones)] = ones
        counts = pad.reshape(-1, BLOCK_BITS).sum(axis=1, dtype=np.uint64)
        directory.append(np.array([len(b) for b in stored], "<u4").tobytes() + (np.cumsum(counts) - counts).astype("<u8").tobytes())
        planes.append({"at": at, "blocks": len(blocks), "ones": int(counts.sum())})
        for b in stored:
            out.write(b)
            at += len(b)
        rest = np.concatenate([np.compress(~ones, rest), np.compress(ones, rest)])
    for plane, raw in zip(planes, directory):
        plane["directory"] = at
        out.write(raw)
        at += len(raw)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema) as stream:
        stream.write_batch(docs)
    raw = squeeze(sink.getvalue().to_pybytes())
    footer = json.dumps({"tokens": len(ids), "levels": levels, "planes": planes, "docs": [at, len(raw)]}).encode()
    out.write(raw)
    out.write(footer)
    out.write(np.array([len(footer)], "<u4").tobytes())
    out.write(MAGIC)
    return at + len(raw) + len(footer) + 4 + len(MAGIC)


class MatrixFile:
    """Reader of one file, given as a seekable binary stream; reads what is asked for only."""

    def __init__(self, stream, size: int, kept_blocks: int = 256):
        self.stream = stream
        tail = self._read(size - 4 - len(MAGIC), 4 + len(MAGIC))
        if tail[4:] != MAGIC or self._read(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a wavelet-matrix file")
        length = int(np.frombuffer(tail[:4], "<u4")[0])
        self.footer = json.loads(self._read(size - 4 - len(MAGIC) - length, length))
        self.tokens, self.levels = self.footer["tokens"], self.footer["levels"]
        self.zeros = [self.tokens - p["ones"] for p in self.footer["planes"]]
        self.directories: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.block = lru_cache(kept_blocks)(self._block)

    def _read(self, at: int, length: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(length)

    def documents(self) -> pa.RecordBatch:
        raw = zstandard.ZstdDecompressor().decompress(self._read(*self.footer["docs"]))
        return pa.ipc.open_stream(raw).read_all().combine_chunks().to_batches()[0]

    def _directory(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of a plane's blocks (one more ends the last) and the ones before each."""
        if level not in self.directories:
            plane = self.footer["planes"][level]
            n = plane["blocks"]
            raw = self._read(plane["directory"], 12 * n)
            places = plane["at"] + np.r_[0, np.cumsum(np.frombuffer(raw[: 4 * n], "<u4").astype(np.int64))]
            self.directories[level] = places, np.frombuffer(raw[4 * n :], "<u8").astype(np.int64)
        return self.directories[level]

    def _bits(self, level: int, block: int) -> np.ndarray:
        places, _ = self._directory(level)
        raw = self._read(int(places[block]), int(places[block + 1] - places[block]))
        n = min(BLOCK_BITS, self.tokens - block * BLOCK_BITS)
        if len(raw) < -(-n // 8):
            raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=BLOCK_BITS // 8)
        return np.unpackbits(np.frombuffer(raw, np.uint8), count=n)

    def _block(self, level: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Bits of a block, and for each place in it (and its end) the plane's ones before."""
        bits = self._bits(level, block)
        return bits, self._directory(level)[1][block] + np.r_[0, np.cumsum(bits, dtype=np.int64)]

    def _step(self, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bit and number of ones before, for positions in a plane (its end has bit 0)."""
        bit, ones = np.zeros(len(at), np.int64), np.full(len(at), self.tokens - self.zeros[level])
        block = at // BLOCK_BITS
        for b in np.unique(block[at < self.tokens]).tolist():
            here = (block == b) & (at < self.tokens)
            bits, before = self.block(level, b)
            bit[here], ones[here] = bits[at[here] % BLOCK_BITS], before[at[here] % BLOCK_BITS]
        return bit, ones

    def access(self, positions: np.ndarray) -> np.ndarray:
        """The ids at the given positions."""
        at, out = np.asarray(positions, np.int64), np.zeros(len(positions), np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.tokens):
            raise IndexError("position outside the file")
        for level in range(self.levels):
            bit, ones = self._step(level, at)
            out = out * 2 + bit
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
        return out

    def _range(self, ids: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the occurrences of each id in [lo, hi) lie below the last plane."""
        ends = np.concatenate([lo, hi])
        for level in range(self.levels):
            _, ones = self._step(level, ends)
            bit = np.tile((ids >> (self.levels - 1 - level)) & 1, 2)
            ends = np.where(bit == 1, self.zeros[level] + ones, ends - ones)
        return ends[: len(ids)], ends[len(ids) :]

    def count(self, ids, lo=0, hi=None) -> np.ndarray:
        """How often each id occurs in positions [lo, hi)."""
        ids = np.atleast_1d(np.asarray(ids, np.int64))
        lo, hi = (np.broadcast_to(np.clip(x, 0, self.tokens), ids.shape).astype(np.int64) for x in (lo, self.tokens if hi is None else hi))
        known = (ids >= 0) & (ids < 1 << self.levels)
        a, b = self._range(np.where(known, ids, 0), lo, np.maximum(lo, hi))
        return np.where(known, b - a, 0)

    def select(self, token: int, nth: np.ndarray) -> np.ndarray:
        """Positions of the given occurrences (from 0) of one id."""
        nth = np.asarray(nth, np.int64)
        if len(nth) and (nth.min() < 0 or nth.max() >= self.count(token)[0]):
            raise IndexError("no such occurrence")
        if not len(nth):
            return nth
        at = self._range(np.array([token]), np.zeros(1, np.int64), np.full(1, self.tokens))[0][0] + nth
        for level in range(self.levels - 1, -1, -1):
            one = (token >> (self.levels - 1 - level)) & 1
            at = self._nth(level, one, at - self.zeros[level] * one)
        return at

    def _nth(self, level: int, one: int, nth: np.ndarray) -> np.ndarray:
        """Positions of the nth (from 0) ones or zeros of a plane."""
        before = self._directory(level)[1]
        if not one:
            before = np.arange(len(before)) * BLOCK_BITS - before
        block = np.searchsorted(before, nth, "right") - 1
        out = np.empty(len(nth), np.int64)
        for b in np.unique(block).tolist():
            here = block == b
            places = np.flatnonzero(self.block(level, b)[0] == one)
            out[here] = b * BLOCK_BITS + places[nth[here] - before[b]]
        return out

    def positions(self, token: int) -> np.ndarray:
        """All positions of an id, in order."""
        return self.select(token, np.arange(self.count(token)[0]))

    def ids(self) -> np.ndarray:
        """All ids, from the last plane up: each plane says how the two halves below it interleave."""
        out = np.zeros(self.tokens, np.uint32)
        for level in range(self.levels - 1, -1, -1):
            blocks = [self._bits(level, b) for b in range(self.footer["planes"][level]["blocks"])]
            ones = np.concatenate(blocks).view(bool) if blocks else np.zeros(0, bool)
            above = np.empty_like(out)
            above[np.flatnonzero(~ones)] = out[: self.zeros[level]]
            above[np.flatnonzero(ones)] = out[self.zeros[level] :] | np.uint32(1 << (self.levels - 1 - level))
            out = above
        return out


def open_matrix(path: str) -> MatrixFile:
    """A file by its path or URI (local, hdfs, s3, gs)."""
    fs, place = pa.fs.FileSystem.from_uri(path)
    return MatrixFile(fs.open_input_file(place), fs.get_file_info(place).size)


# -- Spark jobs over them ----------------------------------------------------

def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 2, text_col: str = "text", id_col: str = "doc_id", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode every text, append ``end_id`` and write all ids in ascending order of
    ``id_col`` to wavelet-matrix files in ``folder``, which all executors must reach;
    returns the table of files (staged): shard, path, n_docs, n_tokens, n_bytes, start
    (ids in all files before it).

    A null or empty text has the end id alone. Rows with the same id follow each other
    in input order, a null id comes first, an empty table gives no files; other columns
    of ``docs`` are ignored. Texts are dealt to tasks by ranges of (id, input order), so
    that neither many rows of one id nor many texts gather in one task; a file ends after
    the document that fills ``shard_tokens``. Each attempt of a task writes files of its own
    names, and the table names those of the attempts that Spark took, so a lost executor
    or a repeated task leaves at most files that nothing refers to.
    """
    root = folder.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded_encoder(tokenizer_path)
        fs, place = pa.fs.FileSystem.from_uri(root)
        pid, number = TaskContext.get().partitionId(), 0
        kept_ids: list[pa.Array] = []
        counts: list[int] = []
        raw: list[bytes] = []
        total = 0

        def flush() -> pa.RecordBatch:
            name = f"{pid:06d}-{number:06d}-{uuid.uuid4().hex}.wvm"
            docs_of = pa.record_batch([pa.concat_arrays(kept_ids), pa.array(counts, pa.int64())], ["id", "n_tokens"])
            ids = np.frombuffer(b"".join(raw), "<u4")
            with fs.open_output_stream(f"{place}/{name}") as out:
                size = write_matrix(out, ids.astype(np.uint16) if not len(ids) or ids.max() < 1 << 16 else ids, docs_of)
            row = [pid << 32 | number, f"{root}/{name}", len(counts), total, size]
            kept_ids.clear(), counts.clear(), raw.clear()
            return pa.record_batch([pa.array([x]) for x in row], ["shard", "path", "n_docs", "n_tokens", "n_bytes"])

        end = np.array([end_id], "<u4").tobytes()
        fs.create_dir(place, recursive=True)
        for batch in batches:
            row = 0
            for texts in text_runs(batch.column(1)):
                for i, ids in enumerate(encoder(texts)):
                    raw += [ids, end]
                    counts.append(len(ids) // 4 + 1)
                    kept_ids.append(batch.column(0).slice(row + i, 1))
                    total += counts[-1]
                    if total >= shard_tokens:
                        yield flush()
                        total, number = 0, number + 1
                row += len(texts)
        if counts:
            yield flush()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("_row"))
    dealt = rows.repartitionByRange("id", "_row").sortWithinPartitions("id", "_row").drop("_row")
    files = staged(dealt.mapInArrow(run, "shard long, path string, n_docs long, n_tokens long, n_bytes long"), "token_files")
    # running sums in two steps: shards of a task, then tasks (one row each)
    part = F.shiftrightunsigned("shard", 32)
    inside = Window.partitionBy("_part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy(part.alias("_part")).agg(F.sum("n_tokens").alias("_n"))
    before = parts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    placed = files.withColumn("_part", part).withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(before, "_part")
    return staged(placed.select("shard", "path", "n_docs", "n_tokens", "n_bytes", (F.col("_before") + F.col("_inside")).alias("start")), "token_files")


def _spread(files: DataFrame) -> DataFrame:
    """The table of files, about one file a task."""
    return files.repartition(max(1, min(files.count(), READ_TASKS)), "path")


def token_documents(files: DataFrame, id_type: str = "bigint", id_col: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """Documents as the files hold them: ``id_col``, start (ids of all documents before),
    n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers), and with
    ``keep_ids`` the ids. An empty table of files gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                matrix = open_matrix(path)
                docs, ids = matrix.documents(), matrix.ids().astype("<u4")
                counts = docs.column(1).to_numpy()
                ends = np.cumsum(counts)
                raw = memoryview(ids.tobytes())
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - counts).tolist(), ends.tolist())]
                columns = [docs.column(0), pa.array(start + ends - counts), docs.column(1), pa.array(sums, pa.int64())]
                names = ["id", "start", "n_tokens", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.record_batch(columns, names)

    schema = f"id {id_type}, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    return _spread(files.select("path", "start")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def token_frequencies(files: DataFrame, tokens: list[int]) -> DataFrame:
    """How often each of the given ids occurs in all files (token_id, n): counted on the
    bit-planes, two positions a plane and id, without reading the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield pa.record_batch([pa.array(tokens, pa.int64()), pa.array(open_matrix(path).count(tokens))], ["token_id", "n"])

    return _spread(files.select("path")).mapInArrow(run, "token_id long, n long").groupBy("token_id").agg(F.sum("n").alias("n"))


def token_occurrences(files: DataFrame, tokens: list[int], id_type: str = "bigint", id_col: str = "doc_id") -> DataFrame:
    """Every occurrence of the given ids: token_id, position (in all files), ``id_col`` and place in the document (from 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                matrix = open_matrix(path)
                docs = matrix.documents()
                starts = np.cumsum(docs.column(1).to_numpy()) - docs.column(1).to_numpy()
                for token in tokens:
                    at = matrix.positions(token)
                    doc = np.searchsorted(starts, at, "right") - 1
                    yield pa.record_batch([pa.array(np.full(len(at), token)), pa.array(start + at), docs.column(0).take(pa.array(doc)), pa.array(at - starts[doc])], ["token_id", "position", "id", "place"])

    return _spread(files.select("path", "start")).mapInArrow(run, f"token_id long, position long, id {id_type}, place long").withColumnRenamed("id", id_col)


def tokens_at(files: DataFrame, wanted: DataFrame, position_col: str = "position", block: int = 1 << 20) -> DataFrame:
    """The ids at given positions of all files (position, token_id); positions outside give no row.

    Positions meet files by blocks of ``block`` positions, of which each file lists those
    it touches, so that neither table is sent whole to every task."""
    at = F.col("position")
    spans = files.where("n_tokens > 0").select("path", "start", (F.col("start") + F.col("n_tokens")).alias("end"))
    blocks = spans.withColumn("_block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block))))
    found = wanted.select(F.col(position_col).cast("long").alias("position")).withColumn("_block", F.floor(at / block)).join(blocks, "_block").where((at >= F.col("start")) & (at < F.col("end")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, matrix = None, None
        for batch in batches:
            paths, positions, starts = batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            cuts = [0, *(i for i in range(1, len(paths)) if paths[i] != paths[i - 1]), len(paths)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo < hi:
                    if paths[lo] != path:
                        path, matrix = paths[lo], open_matrix(paths[lo])
                    yield pa.record_batch([pa.array(positions[lo:hi]), pa.array(matrix.access(positions[lo:hi] - starts[lo:hi]))], ["position", "token_id"])

    dealt = found.select("path", "position", "start").repartitionByRange("path", "position").sortWithinPartitions("path", "position")
    return dealt.mapInArrow(run, "position long, token_id long")


def token_file_report(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write the files to a new folder under the shared scratch folder and read every document back
    (see ``write_token_files`` and ``token_documents`` for nulls, ties and empty tables)."""
    files = write_token_files(docs, tokenizer_path, scratch_path(docs.sparkSession, "llm", "wavelet"), end_id)
    return token_documents(files, docs.schema["doc_id"].dataType.simpleString())
