"""Language-model scoring by a weighted backoff automaton.

All words and n-grams of the training part are counted by shuffle; an n-gram that
occurs MIN_COUNT times or more has an arc with its discounted log-probability, and
each context with arcs has a failure arc with its backoff weight to the next shorter
one. Nothing of it is broadcast.

Texts are kept compressed in blocks of some megabytes. A block's distinct n-grams go,
as packed sorted keys with their counts, to bins of a range of keys each; a bin adds up
and answers in the order it was asked, so no key travels back. One block of all that
hold an n-gram owns it and counts it among the arcs of its context; these sums meet in
the context's bin, under its rank there, and are answered likewise. With both answers
a block has the part of the automaton that it can reach, and one left-to-right
traversal of its texts carries the state and adds up the log-probabilities.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.text import LOWER, SLICE_BYTES, SPACED, mix, release_memory, staged, text_slices, utf8, word_hashes, word_spans

#: Least share of all tokens that a word or an n-gram in the automaton has: none.
WORD_SHARE = 0.0
GRAM_SHARE = 0.0
#: Least count of an n-gram (n above 1) in the automaton, whatever the input's size.
MIN_COUNT = 2
ORDER = 3
#: Taken from each n-gram's count for the failure arc (n above 1).
DISCOUNT = 0.5
#: Tokens that one lane of the traversal goes through.
LANE = 256
#: Bytes of text in a block, one text at least.
BLOCK_BYTES = 8 << 20
#: Bytes of text for each bin of keys: a bin holds about as many keys as these have distinct n-grams of one level.
BIN_BYTES = 16 << 20
#: Rows that a task hands on at once.
BATCH_ROWS = 1 << 16
#: Parts of the blocks whose texts meet their answers one after the other, as exchanged texts and answers take disk.
PARTS = 3
CODEC = pa.Codec("zstd")
#: Spark's setting by which an execution's shuffle files are removed when it has ended.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Fixed values that stand for the beginning and the end of a text among the words' hashes.
BEGIN = np.uint64(0x2B7E151628AED2A6)
END = np.uint64(0x5EED0FE0D0F7E575)


def token_stream(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's words between a BEGIN and an END, and the texts' token offsets."""
    tokens, firsts, lo = [], [np.zeros(1, np.int64)], 0
    while lo < len(offs) - 1:  # hashing takes many times the bytes at hand: some texts at a time
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + SLICE_BYTES, "right")) - 1)
        found, ends = _tokens(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
        tokens.append(found)
        firsts.append(ends[1:] + firsts[-1][-1])
        lo = hi
    return np.concatenate([np.empty(0, np.uint64), *tokens]), np.concatenate(firsts)


def _tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = LOWER[data]
    starts, ends, first = word_spans(data, offs, SPACED)
    n = len(offs) - 1
    tokens = np.full(len(starts) + 2 * n, END, np.uint64)
    owner = np.repeat(np.arange(n), np.diff(first))
    tokens[np.arange(len(starts)) + 2 * owner + 1] = word_hashes(data, starts, ends)
    firsts = first + 2 * np.arange(n + 1)
    tokens[firsts[:-1]] = BEGIN
    return tokens, firsts


def gram_keys(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Key of an n-gram by those of the two (n-1)-grams that it begins and ends with."""
    return mix(context * np.uint64(0x9E6C63D0876A9A99) + suffix)


def sorting(values: np.ndarray) -> np.ndarray:
    """Places of whole numbers in their order, equal ones as they come. Sorting numbers is
    many times as fast as sorting places, so a number and its place are put into one, as far as they fit."""
    n = len(values)
    if n < 2:
        return np.arange(n)
    low, bits = values.min(), n.bit_length()
    both = (values - low).astype(np.uint64)
    room = 64 - int(both.max()).bit_length()
    both <<= np.uint64(min(room, bits))
    if room < bits:
        both >>= np.uint64(bits)
        both <<= np.uint64(bits)
    both |= np.arange(n, dtype=np.uint64)
    both.sort()
    both &= np.uint64((1 << bits) - 1)
    by = both.view(np.int64)
    if room < bits:
        found = values[by]
        if (found[1:] < found[:-1]).any():  # unequal numbers that begin alike
            return np.argsort(values, kind="stable")
    return by


def ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order: the place of the first of each, and for each value its rank."""
    by = sorting(values)
    found = values[by]
    new = np.ones(len(by), bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    rank = np.empty(len(by), np.int32)
    rank[by] = np.cumsum(new, dtype=np.int32) - 1
    return by[new], rank


def distinct(values: np.ndarray, counted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order and how often each comes, of those that are ``counted`` if given."""
    values, rest = np.sort(values), None if counted is None or counted.all() else values[~counted]
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(values)), bool), values[1:] != values[:-1]]))
    found, counts = values[starts], np.diff(starts, append=len(values))
    if rest is not None:
        rest, other = distinct(rest)
        counts[np.searchsorted(found, rest)] -= other
    return found, counts


def distinct_grams(tokens: np.ndarray, firsts: np.ndarray, levels: list[int], counted: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each of ``levels`` (in order) the keys of the distinct n-grams, sorted, and how often
    they occur, with a ``counted`` last token if given. The keys are those of ``Grams``."""
    keys, place = tokens, np.arange(len(tokens)) - np.repeat(firsts[:-1], np.diff(firsts))
    for m in range(1, levels[-1] + 1):
        if m > 1:
            keys = gram_keys(keys[:-1], keys[1:])  # those that reach over two texts are left out below
        if m in levels:
            inside = place[m - 1 :] >= m - 1
            yield m, *distinct(keys[inside], None if counted is None else counted[m - 1 :][inside])


class Grams:
    """The distinct n-grams of some texts, level 1 being the words with BEGIN and END.

    For each level m: ``keys[m]`` sorted, the places of the (m-1)-grams that each begins
    and ends with (``context[m]``, ``suffix[m]``), and for each token the place of the
    m-gram that ends with it (``ending[m]``; without meaning for a text's first m - 1).
    ``ids``: the place of each token among the words.
    """

    def __init__(self, tokens: np.ndarray, firsts: np.ndarray, order: int):
        self.keys, self.context, self.suffix, self.ending = {}, {}, {}, {}
        at, self.ids = ranked(tokens)
        self.keys[1], self.ending[1] = tokens[at], self.ids
        place = np.arange(len(tokens)) - np.repeat(firsts[:-1], np.diff(firsts))
        before = self.ids
        for m in range(2, order + 1):
            ends = np.flatnonzero(place >= m - 1)
            # one number for each pair of places, so that the sort is on those and not on hashes
            at, inverse = ranked(before[ends - 1].astype(np.int64) * len(self.keys[m - 1]) + before[ends])
            context, suffix = before[ends[at] - 1], before[ends[at]]
            keys = gram_keys(self.keys[m - 1][context], self.keys[m - 1][suffix])
            by = sorting(keys)
            rank = np.empty(len(by), np.int32)
            rank[by] = np.arange(len(by), dtype=np.int32)
            self.keys[m] = keys[by]
            self.context[m], self.suffix[m] = context[by], suffix[by]
            before = self.ending[m] = np.zeros(len(tokens), np.int32)
            before[ends] = rank[inverse]


class Automaton:
    """The part of the automaton that some texts can reach. States are numbers, 0 the
    root; a state of depth d stands for the d tokens read last, so that its arc by the
    next token is the (d+1)-gram that ends there.

    For each level m of ``grams``: ``arc[m]`` tells which n-grams have an arc, ``logp[m]``
    has their log10 probabilities and ``backoff[m]`` the backoff weights (NaN for an
    n-gram without arcs).
    """

    def __init__(self, grams: Grams, order: int, arc: dict[int, np.ndarray], logp: dict[int, np.ndarray], backoff: dict[int, np.ndarray]):
        self.order, self.ending, self.arc, self.logp = order, grams.ending, arc, logp
        weights, fails, depths = [np.zeros(1)], [np.zeros(1, np.int32)], [np.zeros(1, np.int8)]
        self.next: dict[int, np.ndarray] = {}  # the state of an n-gram's longest suffix that has arcs, itself included
        states = 1
        for m in range(1, order + 1):
            below = self.next[m - 1][grams.suffix[m]] if m > 1 else np.zeros(len(grams.keys[1]), np.int32)
            if m < order:
                has = np.flatnonzero(~np.isnan(backoff[m]))
                weights.append(backoff[m][has])
                fails.append(below[has])
                depths.append(np.full(len(has), m, np.int8))
                below[has] = np.arange(states, states + len(has), dtype=np.int32)
                states += len(has)
            self.next[m] = below
        self.backoff, self.fail, self.depth = map(np.concatenate, (weights, fails, depths))

    def step(self, states: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One token (its place in the texts) for each lane: log10 probabilities and next states."""
        logp, following = np.zeros(len(states)), np.zeros(len(states), np.int32)
        at = states.copy()
        open_ = np.arange(len(states))
        for m in range(self.order, 0, -1):  # failure arcs only lead to lesser depths
            here = self.depth[at[open_]] == m - 1
            lanes, open_ = open_[here], open_[~here]
            gram = self.ending[m][tokens[lanes]]
            if m > 1:
                hit = self.arc[m][gram]
                failing = lanes[~hit]
                logp[failing] += self.backoff[at[failing]]
                at[failing] = self.fail[at[failing]]
                open_ = np.concatenate([open_, failing])
                lanes, gram = lanes[hit], gram[hit]
            logp[lanes] += self.logp[m][gram]
            following[lanes] = self.next[m][gram]
        return logp, following

    def traverse(self, firsts: np.ndarray) -> np.ndarray:
        """log10 probability of each token, read left to right; 0 for each text's BEGIN.

        The tokens are dealt to lanes that run side by side; a state depends on no more
        than the last order - 1 tokens of its text, so a lane that starts inside a
        text reads these first, without adding them.
        """
        n = len(self.ending[1])
        out = np.zeros(n)
        if not n:
            return out
        lane = np.arange(0, n, LANE)
        end = np.minimum(lane + LANE, n)
        begins = np.zeros(n, bool)
        begins[firsts[:-1]] = True
        text_begin = firsts[:-1][np.searchsorted(firsts[:-1], lane, "right") - 1]
        at = np.maximum(lane - (self.order - 1), text_begin)
        states = np.zeros(len(lane), np.int32)
        while True:
            going = np.flatnonzero(at < end)
            if not len(going):
                return out
            here = at[going]
            logp, states[going] = self.step(np.where(begins[here], 0, states[going]), here)
            counted = (here >= lane[going]) & ~begins[here]
            out[here[counted]] = logp[counted]
            at[going] += 1


def is_training(id_col: Column, folds: int = 7, held_out: int = 2) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))), F.lit(folds)) != held_out


def signed(keys: np.ndarray) -> pa.Array:
    return pa.array(keys.view(np.int64))


def pack(*arrays: np.ndarray) -> bytes:
    """Whole numbers from 0 on, each array as its planes of bytes; those that vary little are compressed."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a, "<u8")
        planes, used = [], (int(a.max()).bit_length() + 7) // 8 if len(a) else 0
        for i in range(used):
            plane = a.view(np.uint8)[i::8].tobytes()
            small = CODEC.compress(plane, asbytes=True) if used < 5 or i >= used - 2 else plane  # else low bits of hashes
            planes.append(small if len(small) < len(plane) else plane)
        out += [np.array([len(a), len(planes), *map(len, planes)], "<u4").tobytes(), *planes]
    return b"".join(out)


def unpack(blob: bytes) -> list[np.ndarray]:
    arrays, at = [], 0
    while at < len(blob):
        n, planes = np.frombuffer(blob, "<u4", 2, at).tolist()
        sizes = np.frombuffer(blob, "<u4", planes, at + 8).tolist()
        at += 8 + 4 * planes
        a = np.zeros((n, 8), np.uint8)
        for i, size in enumerate(sizes):
            plane = blob[at : at + size]
            a[:, i] = np.frombuffer(plane if size == n else CODEC.decompress(plane, n, asbytes=True), np.uint8)
            at += size
        arrays.append(a.reshape(-1).view("<u8"))
    return arrays


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (id, training, text) as a row for each run of about BLOCK_BYTES: (block, size, ids, rows, texts)."""
    number, parts, filled = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        _, offs = utf8(batch.column(2))
        lo = 0
        for i, size in enumerate((np.diff(offs) + 1).tolist()):
            if filled and filled + size > BLOCK_BYTES:
                yield _block(number, [*parts, batch.slice(lo, i - lo)])
                number, parts, filled, lo = number + 1, [], 0, i
            filled += size
        parts.append(batch.slice(lo))
    if filled:
        yield _block(number, parts)


def _block(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    ids, training, texts = (pa.concat_arrays([part.column(i) for part in parts]) for i in range(3))
    data, offs = utf8(texts)
    data = data[offs[0] : offs[-1]]
    rows = pack(np.diff(offs), training.to_numpy(zero_copy_only=False))
    ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
    packed = pa.array([CODEC.compress(data.tobytes(), asbytes=True)], pa.binary())
    return pa.record_batch([pa.array([number]), pa.array([len(data)]), ids, pa.array([rows], pa.binary()), packed], ["block", "size", "ids", "rows", "texts"])


def _texts(rows: bytes, texts: bytes) -> pa.RecordBatch:
    """(text, training) of a block."""
    lengths, training = unpack(rows)
    offs = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths).astype(np.int64)])
    data = CODEC.decompress(texts, int(offs[-1])) if offs[-1] else pa.py_buffer(b"")
    column = pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offs), data)
    return pa.record_batch([column, pa.array(training.astype(bool))], ["text", "training"])


def _in_batches(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, rows.num_rows, BATCH_ROWS):
        yield rows.slice(at, BATCH_ROWS)


def _grams(texts: pa.RecordBatch, order: int) -> tuple[Grams, np.ndarray]:
    stream, firsts = token_stream(*utf8(texts.column(0)))
    return Grams(stream, firsts, order), firsts


def _gram_rows(batches: Iterator[pa.RecordBatch], order: int, levels: list[int] | None = None) -> Iterator[pa.RecordBatch]:
    """(m, key, n) for the distinct n-grams of each slice of the texts (text, and if they train), by level and key; n counts those of training texts."""
    for batch in batches:
        training = None if batch.num_columns == 1 else batch.column(1).to_numpy(zero_copy_only=False)
        for lo, hi, data, offs in text_slices(batch.column(0), BLOCK_BYTES):
            stream, firsts = token_stream(data, offs)
            counted = None if training is None else np.repeat(training[lo:hi], np.diff(firsts))
            for m, keys, n in distinct_grams(stream, firsts, levels or [*range(1, order + 1)], counted):
                yield from _in_batches(pa.record_batch([pa.array(np.full(len(keys), m, np.int32)), signed(keys), pa.array(n)], ["m", "key", "n"]))
            release_memory()  # beside other workers and the JVM


def bin_of(keys: np.ndarray, bins: int) -> np.ndarray:
    """Which of some equal ranges of keys each is in."""
    return ((keys >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)


ASKED = "m int, bin long, block long, at long, first long, keys binary"


def _asked(batches: Iterator[pa.RecordBatch], levels: list[int], bins: int) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of each block (block, rows, texts), in pieces of one level and bin:
    ``at`` is the place of a piece's first in the block's level, ``keys`` the steps between keys and the counts."""
    for batch in batches:
        for block, rows, texts in zip(*(batch.column(i) for i in range(3))):
            done: Counter[int] = Counter()
            for found in _gram_rows(iter([_texts(rows.as_py(), texts.as_py())]), levels[-1], levels):
                m, keys, counts = found.column(0)[0].as_py(), found.column(1).to_numpy().view(np.uint64), found.column(2).to_numpy()
                bin_ = bin_of(keys, bins)
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(bin_)) + 1, [len(keys)]]).tolist()
                pieces = [pack(np.diff(keys[a:b], prepend=keys[a]), counts[a:b]) for a, b in zip(cuts, cuts[1:])]
                starts, n = np.array(cuts[:-1]), len(pieces)
                yield pa.record_batch([pa.array(np.full(n, m, np.int32)), pa.array(bin_[starts]), pa.array(np.full(n, block.as_py())), pa.array(starts + done[m]), signed(keys[starts]), pa.array(pieces, pa.binary())], ["m", "bin", "block", "at", "first", "keys"])
                done[m] += len(keys)


COUNTED = "m int, bin long, block long, at long, found binary, tokens long, types long, ones long, twos long"


def _counted(order: int):
    """Of a bin's pieces: for each key its count over all blocks twice, one more for the first block that
    has it (0 for an n-gram below MIN_COUNT); below ``order`` also the steps between the ranks of those
    that reach MIN_COUNT. One row has the bin's words: tokens, types, and those that occur once and twice."""

    def run(key: tuple, part: pa.Table) -> pa.Table:
        m, keys, counts = key[0].as_py(), [], []
        for first, blob in zip(part["first"].to_numpy().view(np.uint64), part["keys"]):
            steps, n = unpack(blob.as_py())
            keys.append(np.cumsum(steps) + first)
            counts.append(n)
        ends = np.cumsum([0, *map(len, keys)]).tolist()
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        by = sorting(keys)
        keys, counts = keys[by], counts[by]
        new = np.ones(len(keys), bool)
        np.not_equal(keys[1:], keys[:-1], out=new[1:])
        starts = np.flatnonzero(new)
        n = np.add.reduceat(counts, starts).astype(np.int64)
        group = np.empty(len(keys), np.int64)
        group[by] = np.cumsum(new) - 1
        twice = np.zeros(len(keys), np.int64)
        twice[by[starts]] = 1
        words = n[(keys[starts] != BEGIN) & (n > 0)] if m == 1 else n[:0]
        del keys, counts, by
        often = n >= MIN_COUNT
        if m > 1:
            n = np.where(often, n, 0)
        rank = np.cumsum(often) - 1
        twice += 2 * n[group]
        found = []
        for a, b in zip(ends, ends[1:]):
            own = group[a:b][often[group[a:b]]]
            found.append(pack(twice[a:b], np.diff(rank[own], prepend=0)) if m < order else pack(twice[a:b]))
        totals = np.zeros((4, part.num_rows), np.int64)
        totals[:, 0] = words.sum(), len(words), (words == 1).sum(), (words == 2).sum()
        release_memory()
        return pa.table([*(part[c] for c in ("m", "bin", "block", "at")), pa.array(found, pa.binary()), *map(pa.array, totals)], ["m", "bin", "block", "at", "found", "tokens", "types", "ones", "twos"])

    return run


@contextmanager
def _shuffles_removed(spark: SparkSession):
    """What is run in this block leaves no shuffle files when it has ended: its results are written or collected."""
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(REMOVE_SHUFFLES) if before is None else spark.conf.set(REMOVE_SHUFFLES, before)


def _with_answers(blocks: DataFrame, answers: DataFrame, run, schema: str, parts: int, name: str) -> DataFrame:
    """``run`` over each block and its answers, staged part by part."""
    done = None
    for i in range(parts):
        own = F.pmod(F.xxhash64("block"), F.lit(parts)) == i
        part = blocks.filter(own).groupBy("block").cogroup(answers.filter(own).groupBy("block")).applyInArrow(run, schema)
        part = staged(part, name)
        done = part if done is None else done.unionAll(part)
    return done


class Model:
    """``answers``: (block, m, at, weights, blob), for each block what ``_counted`` found and, with
    ``weights``, the sums over the arcs of its contexts, by which ``read`` has its part of the automaton."""

    def __init__(self, blocks: DataFrame, order: int, word_share: float, gram_share: float):
        self.order = order
        texts = blocks.select("block", "rows", "texts")
        bins = -(-max(1, blocks.agg(F.sum("size")).first()[0] or 0) // BIN_BYTES)
        self.parts, counted = min(PARTS, bins), None
        # words and pairs first, then level by level, so that the exchanges are not on disk at once
        for levels in [[*range(1, min(order, 2) + 1)], *([m] for m in range(3, order + 1))]:
            asked = texts.mapInArrow(lambda b, levels=levels: _asked(b, levels, bins), ASKED)
            found = staged(asked.groupBy("m", "bin").applyInArrow(_counted(order), COUNTED), "lm_counts")
            counted = found if counted is None else counted.unionAll(found)
        totals = counted.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "types", "ones", "twos"))).first()
        self.tokens, self.types, singles, doubles = totals
        #: Ney's estimate from the words that occur once and twice.
        self.discount = min(0.9, singles / (singles + 2 * doubles)) if singles else 0.5
        #: log10 of what the discounts leave, the probability of meeting an unknown word.
        self.unknown = float(np.log10(self.discount * self.types / self.tokens)) if self.tokens else 0.0
        self.least = max(float(MIN_COUNT), gram_share * self.tokens)
        self.least_word = max(self.least, word_share * self.tokens)
        found = counted.select("block", "m", "at", "bin", F.col("found").alias("blob"))
        sums = _with_answers(texts, found, _arc_sums(self), SUMS, self.parts, "lm_sums")
        weights = staged(sums.groupBy("m", "bin").applyInArrow(_added, ADDED), "lm_weights")
        weights = weights.select("block", "m", "at", F.lit(True).alias("weights"), "blob")
        self.answers = found.select("block", "m", "at", F.lit(False).alias("weights"), "blob").unionAll(weights)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "answers"}

    def arcs(self, grams: Grams, n: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        """Which n-grams of each level above 1 have an arc."""
        suffix = n[1] >= self.least_word
        begin = grams.keys[1] == BEGIN
        context, arcs = suffix | begin, {}
        suffix &= ~begin
        for m in range(2, self.order + 1):
            context = suffix = arcs[m] = (n[m] >= self.least) & context[grams.context[m]] & suffix[grams.suffix[m]]
        return arcs

    def read(self, grams: Grams, n: dict[int, np.ndarray], sums: dict[int, np.ndarray]) -> Automaton:
        """``sums[m]``: for each m-gram the number of its arcs, their counts and those of their suffixes."""
        arcs, begin = self.arcs(grams, n), grams.keys[1] == BEGIN
        with np.errstate(divide="ignore", invalid="ignore"):
            word = np.where(n[1] > 0, np.log10((n[1] - self.discount) / max(self.tokens, 1)), self.unknown)
            logp, backoff = {1: np.where(begin, 0.0, word)}, {}
            for m in range(1, self.order + 1):
                if m > 1:
                    logp[m] = np.zeros(len(n[m]))
                    logp[m][arcs[m]] = np.log10((n[m][arcs[m]] - DISCOUNT) / n[m - 1][grams.context[m][arcs[m]]])
                if m < self.order:
                    has = np.flatnonzero(sums[m][0])
                    k, own, below = sums[m][:, has]
                    low = (below - k * self.discount) / max(self.tokens, 1) if m == 1 else (below - k * DISCOUNT) / n[m - 1][grams.suffix[m][has]]
                    backoff[m] = np.full(len(n[m]), np.nan)
                    backoff[m][has] = np.log10(np.maximum(1 - (own - k * DISCOUNT) / n[m][has], 1e-9) / np.maximum(1 - low, 1e-9))
        return Automaton(grams, self.order, arcs, logp, backoff)


def _answered(part: pa.Table, order: int) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray], list[tuple]]:
    """Of the answers of one block: the counts of each level, which n-grams the block owns, and the pieces with ranks (m, bin, at, ranks, from, to)."""
    n, owned = ({m: [np.empty(0, kind)] for m in range(1, order + 1)} for kind in (np.int64, bool))
    pieces = []
    part = part.sort_by([("m", "ascending"), ("at", "ascending")])
    for m, bin_, at, blob in zip(*(part[c].to_pylist() for c in ("m", "bin", "at", "blob"))):
        twice, *ranks = unpack(blob)
        n[m].append((twice >> np.uint64(1)).astype(np.int64))
        owned[m].append((twice & np.uint64(1)).astype(bool))
        if ranks and len(ranks[0]):
            pieces.append((m, bin_, at, ranks[0], at, at + len(twice)))
    return *({m: np.concatenate(x) for m, x in levels.items()} for levels in (n, owned)), pieces


SUMS = "m int, bin long, block long, at long, ranks binary, sums binary"


def _arc_sums(model: Model):
    """For the contexts of a block that reach MIN_COUNT, in the pieces and by the ranks of the answer:
    number, counts and suffixes' counts of the arcs that the block owns."""

    def run(texts: pa.Table, part: pa.Table) -> pa.Table:
        block = texts["block"][0].as_py()
        grams, _ = _grams(_texts(texts["rows"][0].as_py(), texts["texts"][0].as_py()), model.order)
        n, owned, pieces = _answered(part, model.order)
        arcs, sums, out = model.arcs(grams, n), {}, []
        for m in range(1, model.order):
            own = arcs[m + 1] & owned[m + 1]
            context = grams.context[m + 1][own]
            add = lambda x: np.bincount(context, x, len(n[m])).astype(np.int64)  # noqa: B023, E731
            sums[m] = add(None), add(n[m + 1][own]), add(n[m][grams.suffix[m + 1][own]])
        for m, bin_, at, ranks, a, b in pieces:
            often = n[m][a:b] >= MIN_COUNT
            out.append((m, bin_, block, at, pack(ranks), pack(*(x[a:b][often] for x in sums[m]))))
        del grams, arcs, n, owned
        release_memory()
        kinds = [pa.int32(), *[pa.int64()] * 3, pa.binary(), pa.binary()]
        return pa.table([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], ["m", "bin", "block", "at", "ranks", "sums"])

    return run


ADDED = "m int, block long, at long, blob binary"


def _added(part: pa.Table) -> pa.Table:
    """A bin's sums over all blocks, for the contexts of each piece."""
    pieces = [(np.cumsum(unpack(ranks)[0]).astype(np.int64), sums) for ranks, sums in zip(part["ranks"].to_pylist(), part["sums"].to_pylist())]
    totals = np.zeros((3, 1 + max(int(ranks[-1]) for ranks, _ in pieces)), np.int64)
    for ranks, sums in pieces:
        for total, x in zip(totals, unpack(sums)):
            total[ranks] += x.astype(np.int64)  # a piece has each rank once
    blobs = [pack(*totals[:, ranks]) for ranks, _ in pieces]
    release_memory()
    return pa.table([part["m"], part["block"], part["at"], pa.array(blobs, pa.binary())], ["m", "block", "at", "blob"])


def score_texts(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, word_share: float = WORD_SHARE, gram_share: float = GRAM_SHARE) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_tokens, n_known (tokens that occur in the
    training rows), train_tokens, base_score (add-one unigrams) and score (the automaton's
    log10 probability of the text), learnt from the rows where ``training`` holds.

    Words are split by ASCII white space, A-Z lower-cased; each text ends with one end
    token, so a null or empty text is one token. Without training rows the scores are
    0. Repeated rows count and are scored each, a null id stays null, an empty table
    gives an empty result, other columns are ignored. ``word_share`` and ``gram_share``,
    if given, leave rarer words and n-grams out of the automaton.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(training, F.lit(False)).alias("training"), text.alias("text"))
    names = [id_col, "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    schema = f"`{id_col}` {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    with _shuffles_removed(docs.sparkSession):
        blocks = rows.mapInArrow(_blocks, f"block long, size long, ids array<{kind}>, rows binary, texts binary")
        # a row has megabytes: a reader takes a row group at once
        blocks = staged(blocks, "lm_blocks", **{"parquet.block.row.count.limit": "1", "parquet.enable.dictionary": "false"})
        model = Model(blocks, order, word_share, gram_share)
        tokens, types, read = model.tokens, model.types, model.read

        def run(texts: pa.Table, part: pa.Table) -> pa.Table:
            ids = texts["ids"].combine_chunks().flatten()
            grams, firsts = _grams(_texts(texts["rows"][0].as_py(), texts["texts"][0].as_py()), order)
            weights = part["weights"].to_numpy()
            found = part.filter(pa.array(~weights)).append_column("bin", pa.nulls(int((~weights).sum()), pa.int64()))
            n, _, _ = _answered(found, order)
            sums = {m: np.zeros((3, len(n[m])), np.int64) for m in range(1, order)}
            added: dict[int, list] = {}
            part = part.filter(pa.array(weights)).sort_by([("m", "ascending"), ("at", "ascending")])
            for m, blob in zip(part["m"].to_pylist(), part["blob"].to_pylist()):
                added.setdefault(m, []).append(np.stack(unpack(blob)).astype(np.int64))
            for m, pieces in added.items():
                sums[m][:, n[m] >= MIN_COUNT] = np.concatenate(pieces, axis=1)
            auto = read(grams, n, sums)
            base = np.log10((n[1] + 1.0) / (tokens + types + 1.0))
            words = np.ones(len(grams.ids), bool)
            words[firsts[:-1]] = False
            sum_up = lambda x: pa.array(np.add.reduceat(np.where(words, x, 0), firsts[:-1]))
            known = sum_up((n[1] > 0)[grams.ids].astype(np.int64))
            total = pa.array(np.full(len(ids), tokens, np.int64))
            out = [ids, pa.array(np.diff(firsts) - 1), known, total, sum_up(base[grams.ids]), sum_up(auto.traverse(firsts))]
            del grams, auto, n, sums, added
            release_memory()
            return pa.table(out, names)

        return _with_answers(blocks.select("block", "ids", "rows", "texts"), model.answers, run, schema, model.parts, "lm_scores")


def held_out_scores(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``score_texts`` learnt from all rows but those whose crc32(id as text) modulo 7 is 2,
    which are ``held_out``; a null id counts as the text ""."""
    scores = score_texts(docs, is_training(F.col(id_col)), id_col, **options)
    return scores.select(id_col, (~is_training(F.col(id_col))).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
