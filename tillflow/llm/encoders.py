"""Ids of whole texts by the tokenizers library's merges, white-space-bounded pieces at a time.

The pre-tokenizers of both kinds of BPE file never join text across a change from
other characters to white space, so a text's ids are those of its pieces, one after
the other. Pieces repeat: the ids of those seen are kept in a bounded table. New ones
are split into pre-tokens here and merged by the library's BPE model, thousands in one
call, with a NUL between them: a pre-token of its own whose id marks the borders.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer, models, pre_tokenizers

from tillflow.llm.text import SPACED, ragged, utf8, word_spans
from tillflow.llm.token_counts import BYTE_LEVEL_PATTERN, byte_alphabet

KEPT_PIECES = 1_000_000
KEPT_CHARS = 40
PIECES_A_CALL = 8192

#: Python counts these as white space, the library's patterns don't: such texts are encoded whole.
_OTHER_SPACE = re.compile("[\x1c-\x1f]").search
#: White space but for the six ASCII characters that texts are cut at as bytes.
RARE_SPACE = "\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_RARE_SPACE = re.compile(f"[{RARE_SPACE}]").search
_NUL = b"\x00"
#: Ends a pre-token among others; no byte of UTF-8.
_END = b"\xff"
#: The character that is written as that byte.
_END_CHAR = "\udcff"


def unknown_letters(splits: Callable[[str], list]) -> str:
    """Letters and numbers of the ``regex`` module that the library's pre-tokenizer takes
    for other characters, its Unicode tables being older; both kinds of file have their own."""
    unassigned = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Cn")
    return "".join(c for c in regex.findall(r"[\p{L}\p{N}]", unassigned) if len(splits(":" + c)) == 1)


class PieceEncoder:
    """Encoder for one BPE file of the tokenizers library, without added begin or end tokens.

    It takes byte-level files, where white space is part of the ids, and lower-casing
    files with word ends, where it is dropped. ``plain_special`` takes the strings of
    special tokens as ordinary text, else they are found as the library does by default.
    """

    def __init__(self, path: str, plain_special: bool = False, kept: int = KEPT_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side already
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.lowers = bool(spec["normalizer"])
        if self.lowers:
            split, level = pre["pretokenizers"]
            pattern = split["pattern"]["Regex"]
            plain = [x["type"] for x in spec["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"] and split["behavior"] == "Removed" and split["invert"] and not level["use_regex"]
        else:
            level, pattern = pre, BYTE_LEVEL_PATTERN
            plain = pre["type"] == "ByteLevel" and pre["use_regex"] and not self.suffix
        if not plain or level["add_prefix_space"] or model["type"] != "BPE" or model["continuing_subword_prefix"]:
            raise ValueError(f"{path}: neither a byte-level file nor a lower-casing one with word ends")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = plain_special
        special = [] if plain_special else [t["content"] for t in spec["added_tokens"]]
        self.special, self.special_starts = regex.compile("|".join(map(regex.escape, special)) or r"(?!)").search, {t[0] for t in special}
        merges = [tuple(p) if isinstance(p, list) else tuple(p.split(" ")) for p in model["merges"]]
        self.merger = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0, **({"end_of_word_suffix": self.suffix} if self.suffix else {})))
        self.merger.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        alphabet = byte_alphabet()
        self.border = model["vocab"][alphabet[0] + self.suffix]
        self.shown = {b: c for b, c in enumerate(alphabet)} | {_END[0]: " "}
        unknown = "".join(map(regex.escape, unknown_letters(self.library.pre_tokenizer.pre_tokenize_str))) or "\U0010ffff"
        exact = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s[\p{{L}}\p{{N}}--[{unknown}]]]")
        exact = exact.replace(r"[\p{L}]", rf"[\p{{L}}--[{unknown}]]").replace(r"[\p{N}]", rf"[\p{{N}}--[{unknown}]]")
        self.quick, self.exact = regex.compile(pattern).findall, regex.compile(exact, regex.VERSION1).findall
        self.has_unknown = re.compile(f"[{unknown}]").search
        self.far = re.compile(f"[{min(unknown)}-\U0010ffff]").search  # much cheaper than the test itself
        self.pieces = str.split if self.lowers else re.compile(r"\s*\S+|\s+").findall
        self.known: dict[str, bytes] = {}
        self.kept = kept

    def _alone(self, piece: str) -> bool:
        return "\0" in piece or bool(_OTHER_SPACE(piece)) or any(c in piece for c in self.special_starts) and bool(self.special(piece))

    def _words(self, run: list[str]) -> bytes:
        """The pre-tokens of the pieces, a NUL after each piece, with ends between them."""
        joined = "\n\0\n".join(run) if self.lowers else "".join(run)
        find = self.exact if self.far(joined) and self.has_unknown(joined) else self.quick
        if not self.lowers and not self._bounded(run[0]):
            return _END.join([_END.join([*[w.encode() for w in find(p)], _NUL]) for p in run])
        if not self.lowers:
            # sorted, so all are bounded: no pre-token reaches from one into the next, and they are split as one text
            words = find(joined)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
            for i in np.searchsorted(ends, np.cumsum([len(p) for p in run])).tolist():
                words[i] += _END_CHAR + "\0"
            return _END_CHAR.join(words).encode("utf-8", "surrogateescape")
        # characters are lowered one by one (no final sigma); no pre-token holds white space here
        words = find(unicodedata.normalize("NFC", joined).replace("Σ", "σ").lower())
        return "\n".join(words).encode().replace(b"\n", _END) + _END + _NUL

    @staticmethod
    def _bounded(piece: str) -> bool:
        """Whether a piece starts with white space and ends with another character."""
        return piece[0].isspace() and not piece[-1].isspace()

    def _learn(self, new: list[str]) -> None:
        if not self.lowers:
            new.sort(key=self._bounded)
        for lo in range(0, len(new), PIECES_A_CALL):
            run = new[lo : lo + PIECES_A_CALL]
            joined = "\n".join(run)
            if "\0" in joined or _OTHER_SPACE(joined) or self.special(joined):
                alone = {p for p in run if self._alone(p)}
                self.known.update((p, np.array(self.library.encode(p, add_special_tokens=False).ids, "<u4").tobytes()) for p in alone)
                run = [p for p in run if p not in alone]
            if not run:
                continue
            shown = self._words(run).decode("latin-1").translate(self.shown)
            ids = np.array(self.merger.encode_batch_fast([shown], add_special_tokens=False)[0].ids, "<u4")
            ends = (np.flatnonzero(ids == self.border) * 4).tolist()
            if len(ends) != len(run):
                raise ValueError("the file merges NUL bytes with others")
            buffer = ids.tobytes()
            self.known.update(zip(run, [buffer[a:b] for a, b in zip([0, *(e + 4 for e in ends[:-1])], ends)]))

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers; null reads as empty."""
        rare = [i for i, t in enumerate(texts) if t and (any(c in t for c in RARE_SPACE[:4]) if t.isascii() else _RARE_SPACE(t))]
        column, counts = self._cut(texts, rare)
        coded = column.dictionary_encode()
        pieces, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        known = self.known
        new = [p for p in pieces if p not in known]
        self._learn(new)
        found = list(map(known.__getitem__, pieces))
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        sizes = lengths[at]
        ids = np.frombuffer(b"".join(found), "<u4")[ragged((np.cumsum(lengths) - lengths)[at], sizes)]
        ends = (np.r_[0, np.cumsum(sizes)][np.cumsum(counts)] * 4).tolist()
        raw = ids.tobytes()
        out = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        for i, ids_of in zip(rare, out[len(texts) :]):
            out[i] = ids_of
        for p in new:
            if len(p) > KEPT_CHARS:
                del known[p]
        if len(known) > self.kept:
            seen = set(pieces)
            self.known = {p: ids for p, ids in known.items() if p in seen} if len(seen) < self.kept else {}
        return out[: len(texts)]

    def _cut(self, texts: list[str | None], rare: list[int]) -> tuple[pa.Array, np.ndarray]:
        """The pieces of all texts and how many each text has. Texts are cut as bytes; the
        ``rare`` ones, with white space of other kinds, count as empty and follow at the end."""
        apart = [[texts[i]] if _OTHER_SPACE(texts[i]) else self.pieces(texts[i]) for i in rare]
        plain = list(texts)
        for i in rare:
            plain[i] = None
        data, offs = utf8(pa.array(plain, pa.large_string()))
        data = data[: offs[-1]]
        if self.lowers:
            starts, ends, first = word_spans(data, offs, SPACED)
            data, places = data[SPACED[data]], np.r_[0, np.cumsum(ends - starts)]
        else:
            space = ~SPACED[data]
            begins = space.copy()
            begins[1:] &= ~space[:-1]
            begins[offs[:-1][np.diff(offs) > 0]] = True
            starts = np.flatnonzero(begins)
            first, places = np.searchsorted(starts, offs), np.r_[starts, len(data)]
        column = pa.LargeStringArray.from_buffers(len(places) - 1, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
        if apart:
            column = pa.concat_arrays([column, pa.array([p for ps in apart for p in ps], pa.large_string())])
        return column, np.r_[np.diff(first), [len(ps) for ps in apart]].astype(np.int64)


_LOADED: dict[tuple[str, bool, int], PieceEncoder] = {}


def loaded_encoder(path: str, plain_special: bool = False, kept: int = KEPT_PIECES) -> PieceEncoder:
    """The encoder of a file, loaded once in a Python worker; it keeps the ids of ``kept`` pieces at most."""
    key = (path, plain_special, kept)
    if key not in _LOADED:
        _LOADED[key] = PieceEncoder(path, plain_special, kept)
    return _LOADED[key]
