"""Token counts by rank-synchronous merging of ragged byte arrays.

The distinct pre-tokens of a slice of texts are held as one flat array of symbols
with offsets. In each round every sequence finds its lowest-rank adjacent pair,
all occurrences of these pairs are merged at once in all sequences, and sequences
without a mergeable pair leave with their number of symbols. No text is cut, and
nothing is shuffled: every task counts its own rows.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: how the byte-level tokenizers split a text before merging.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}]+| ?[\p{N}]+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_FAR = np.int64(1 << 60)
CACHE_WORDS = 300_000
#: Characters whose words are looked up together.
RUN_CHARS = 2 << 20


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    visible Latin-1 characters stand for themselves, the rest follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def newer_letters() -> str:
    """Letters and numbers that the ``regex`` module knows but Python's own Unicode
    tables don't assign yet, as ranges of a character class. The tokenizers library,
    with tables of about Python's age, takes them for other characters."""
    unassigned = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Cn")
    found = [ord(c) for c in regex.findall(r"[\p{L}\p{N}]", unassigned)]
    firsts = [c for c, before in zip(found, [-2, *found]) if c != before + 1]
    lasts = [c for c, after in zip(found, [*found[1:], -2]) if after != c + 1]
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in zip(firsts, lasts))


class Splitter:
    r"""A tokenizer file's split pattern, with \p{L} and \p{N} as its library has them.

    The module's own classes are faster, and differ from these only in texts with
    ``newer_letters``; they show up among the words not seen before, and those
    texts are split again by set differences.
    """

    def __init__(self, pattern: str, newer: str | None = None):
        newer = newer_letters() if newer is None else newer
        self.quick = regex.compile(pattern).findall
        # ``re`` looks a character of a large class up in a table, ``regex`` goes through the class
        self.newer = re.compile(f"[{newer}]" if newer else r"(?!)").search
        self.far = re.compile(f"[{min(newer)}-\U0010ffff]" if newer else r"(?!)").search
        exact = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s[\p{{L}}\p{{N}}--[{newer}]]]")
        exact = exact.replace(r"[\p{L}]", rf"[\p{{L}}--[{newer}]]").replace(r"[\p{N}]", rf"[\p{{N}}--[{newer}]]")
        self.exact = regex.compile(exact, regex.VERSION1).findall

    def split(self, texts: list[str], known: dict) -> tuple[list[list[str]], set[str], set[str]]:
        """Words of each text, those not in ``known``, and which of these must not be kept there."""
        out = [self.quick(t) for t in texts]
        new = {w for words in out for w in words}.difference(known)
        odd = {w for w in new if self.far(w) and self.newer(w)}
        if odd:
            out = [words if odd.isdisjoint(words) else self.exact(t) for t, words in zip(texts, out)]
            new = {w for words in out for w in words}.difference(known)
        return out, new, {w for w in new if self.newer(w)} if odd else odd


class MergeTable:
    """Symbols and ranked pairs of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or not pre["use_regex"] or pre["add_prefix_space"] or model["end_of_word_suffix"]:
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that take surrounding text are not supported")
        vocab = model["vocab"]
        self.size = max(vocab.values()) + 1
        self.bytes_to_id = np.array([vocab[c] for c in byte_alphabet()], np.int64)
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged[order]
        self.special = [t["content"] for t in sorted(spec["added_tokens"], key=lambda t: -len(t["content"]))]

    def count(self, words: list[bytes]) -> np.ndarray:
        """Number of symbols left of each word when no pair can be merged."""
        counts = np.zeros(len(words), np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        owner = np.flatnonzero(lengths > 0)
        lengths = lengths[owner]
        ids = self.bytes_to_id[np.frombuffer(b"".join(words), np.uint8)]
        while len(owner):
            starts = np.cumsum(lengths) - lengths
            seq = np.repeat(np.arange(len(owner)), lengths)
            rank = np.full(len(ids), _FAR)
            key = ids[:-1] * self.size + ids[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = (self.keys[at] == key) & (seq[:-1] == seq[1:])
            rank[:-1][hit] = self.ranks[at[hit]]
            best = np.minimum.reduceat(rank, starts)
            going = best < _FAR
            counts[owner[~going]] = lengths[~going]
            if not going.any():
                break
            merge = np.flatnonzero((rank == best[seq]) & (rank < _FAR))
            # in a run of overlapping occurrences (a a a) every second one merges, from the left
            fresh = np.ones(len(merge), bool)
            fresh[1:] = merge[1:] != merge[:-1] + 1
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(merge)), 0))
            merge = merge[(np.arange(len(merge)) - run) % 2 == 0]
            ids[merge] = self.merged[at[merge]]
            keep = going[seq]
            keep[merge + 1] = False
            lengths = lengths - np.bincount(seq[merge], minlength=len(owner))
            ids, owner, lengths = ids[keep], owner[going], lengths[going]
        return counts


class TokenCounter:
    """Counts of whole texts; the counts of frequent pre-tokens are kept between slices."""

    def __init__(self, merges: MergeTable):
        self.merges = merges
        self.splitter = Splitter(BYTE_LEVEL_PATTERN)
        self.special = regex.compile("|".join(map(regex.escape, merges.special)) or r"(?!)")
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str | None]) -> list[int]:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        # a special string ends one piece of text and starts the next, and is one token
        pieces = [self.special.split(t) if t else [] for t in texts]
        words, new, passing = self.splitter.split([p for ps in pieces for p in ps], self.known)
        new = list(new)
        self.known.update(zip(new, self.merges.count([w.encode() for w in new]).tolist()))
        sums = iter([sum(map(self.known.__getitem__, ws)) for ws in words])
        for w in passing:
            del self.known[w]
        return [sum(next(sums) for _ in ps) + max(len(ps) - 1, 0) for ps in pieces]


def text_runs(column: pa.Array, limit: int = RUN_CHARS) -> Iterator[list[str | None]]:
    """The column's texts in lists of about ``limit`` characters."""
    out: list[str | None] = []
    size = 0
    for value in column:
        text = value.as_py()
        out.append(text)
        size += len(text or "")
        if size >= limit:
            yield out
            out, size = [], 0
    if out:
        yield out


def count_tokens(docs: DataFrame, tokenizer_path: str, text_col: str = "text", id_col: str = "doc_id", limit: int = 512) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_bytes, n_tokens, over_limit.

    The counts are those of the tokenizers library for the given byte-level BPE
    file without added begin or end tokens; strings of the file's special tokens
    count as one token each. A null or empty text has 0 bytes and 0 tokens, a null
    id stays null, repeated rows are counted each, an empty table gives an empty
    result, and other columns of ``docs`` are ignored, whatever their names.
    The tokenizer file is read on the driver; its tables (a few MB, by the file)
    are broadcast.
    """
    spark = docs.sparkSession
    merges = spark.sparkContext.broadcast(MergeTable(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(merges.value)
        for batch in batches:
            counts = [n for texts in text_runs(batch.column(2)) for n in counter.counts(texts)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
