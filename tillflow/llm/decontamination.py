"""Benchmark decontamination by winnowing.

Texts and benchmark items are cut into k-grams of words; of each sliding window of
w k-gram hashes the smallest is kept with its place. Two texts that share k + w - 1
words in a row share a whole window and so a kept hash at the same offset. The
fingerprints are joined, and every hit is extended along its diagonal over the
item's words, compared word by word: what counts is the texts, not the hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.text import LETTERED, LOWER, gram_hashes, list_column, small_side, staged, text_slices, word_hashes, word_spans

#: Words of a window; an item with fewer words is one window.
WINDOW = 10
#: Longest k-gram.
GRAM = 5
#: Words of a text before lower-casing, for Java's and Python's regular expressions.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD_BYTES = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return _WORD_BYTES.findall(LOWER[raw].tobytes())


def schemes(lengths: list[int]) -> list[tuple[int, int]]:
    """(k, w) that find every shared run of each of these lengths (in words).

    For one k a smaller w keeps all that a larger one keeps, so each k is used once.
    """
    least: dict[int, int] = {}
    for n in lengths:
        k = min(n, GRAM)
        least[k] = min(least.get(k, n), n - k + 1)
    return sorted(least.items())


def fingerprints(data: np.ndarray, offs: np.ndarray, kinds: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kept hashes, their word positions, and how many each text has."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, offs, LETTERED)
    words = word_hashes(data, starts, ends)
    owner = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for k, w in kinds:
        grams = gram_hashes(words, k)
        n = len(grams) - w + 1
        if n <= 0:
            continue
        at = np.arange(n)
        best = grams[:n].copy()
        for j in range(1, w):  # the rightmost smallest of each window
            later = grams[j : n + j] <= best
            best[later] = grams[j : n + j][later]
            at[later] = np.flatnonzero(later) + j
        whole = owner[:n] == owner[k + w - 2 : k + w - 2 + n]
        kept = np.unique(at[whole])
        found.append((kept, grams[kept] + np.uint64(k)))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(len(offs) - 1, np.int64)
    place = np.concatenate([p for p, _ in found])
    order = np.argsort(place, kind="stable")
    place, hashes = place[order], np.concatenate([h for _, h in found])[order]
    return hashes, place - first[owner[place]], np.bincount(owner[place], minlength=len(offs) - 1)


def fingerprint_rows(texts: DataFrame, kinds: list[tuple[int, int]]) -> DataFrame:
    """Rows (key, fp, pos) of a table (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_slices(batch.column(1)):
                hashes, places, counts = fingerprints(data, offs, kinds)
                pairs = pa.StructArray.from_arrays([pa.array(hashes.view(np.int64)), pa.array(places, pa.int32())], ["fp", "pos"])
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), list_column(pairs, counts)], ["key", "prints"])

    kind = texts.schema["key"].dataType.simpleString()
    return texts.mapInArrow(run, f"key {kind}, prints array<struct<fp:long,pos:int>>").select("key", F.inline("prints"))


def extend_hits(rows: DataFrame) -> DataFrame:
    """(key, text, hits: array of (item, item_text, diagonal)) to (key, n_hit, items)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n_hit, items = batch.column(0), [], []
            for text, hits in zip(batch.column(1), batch.column(2)):
                words = words_of(text.as_py())
                marked, matched = np.zeros(len(words), bool), set()
                split: dict[str, list[bytes]] = {}
                for hit in hits.as_py():
                    item = split.setdefault(hit["item"], words_of(hit["item_text"]))
                    lo, hi = max(0, hit["diagonal"]), min(len(words), hit["diagonal"] + len(item))
                    least, run_start = min(WINDOW, len(item)), lo
                    for p in range(lo, hi + 1):
                        if p == hi or words[p] != item[p - hit["diagonal"]]:
                            if p - run_start >= least:
                                marked[run_start:p] = True
                                matched.add(hit["item"])
                            run_start = p + 1
                n_hit.append(int(marked.sum()))
                items.append(sorted(matched))
            yield pa.record_batch([keys, pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string()))], ["key", "n_hit", "items"])

    return rows.mapInArrow(run, "key string, n_hit long, items array<string>")


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(key, n_hit, n_items, items_sha256) of the distinct texts of ``docs`` with a hit;
    ``key`` is the text's MD5 digest."""
    # equal items are searched once; their ids come back at the end
    items = benchmark.select(F.md5(F.col(item_text_col)).alias("item"), F.col(item_text_col).alias("item_text"), F.col(item_col).cast("string").alias("item_id")).filter(F.col("item").isNotNull())
    count = F.least(F.regexp_count("item_text", F.lit(WORD)), F.lit(WINDOW))
    lengths = [r[0] for r in items.select(count).distinct().collect() if r[0]]
    distinct_items = items.select("item", "item_text").distinct()
    kinds = schemes(lengths)
    item_prints = fingerprint_rows(distinct_items.select(F.col("item").alias("key"), "item_text"), kinds).select(F.col("key").alias("item"), "fp", F.col("pos").alias("item_pos"))
    texts = docs.filter(F.col(text_col).isNotNull()).select(F.md5(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    # the benchmark is the small side: Spark broadcasts it under its own size limit, else shuffles
    hits = fingerprint_rows(texts, kinds).join(item_prints, "fp").select("key", "item", (F.col("pos") - F.col("item_pos")).alias("diagonal")).distinct()
    hits = staged(hits, "leak_hits")
    keys = staged(hits.select("key").distinct(), "leak_texts")
    found = texts.join(small_side(keys, 48), "key").dropDuplicates(["key"])
    grouped = hits.join(distinct_items, "item").groupBy("key").agg(F.collect_list(F.struct("item", "item_text", "diagonal")).alias("hits"))
    extended = extend_hits(found.join(grouped, "key").select("key", "text", "hits")).filter("n_hit > 0")
    named = extended.select("key", "n_hit", F.explode("items").alias("item")).join(items.select("item", "item_id"), "item")
    ids = F.collect_set("item_id")
    return named.groupBy("key", "n_hit").agg(F.size(ids).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", F.array_sort(ids)), 256).alias("items_sha256"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(id, key, n_words) of a table (id, key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [np.diff(word_spans(LOWER[data], offs, LETTERED)[2]) for _, _, data, offs in text_slices(batch.column(2))]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(np.concatenate(counts))], ["id", "key", "n_words"])

    return texts.mapInArrow(run, f"id {texts.schema['id'].dataType.simpleString()}, key string, n_words long")


def leak_report(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_words, n_hit, n_items, items_sha256, contaminated.

    A null or empty text has no words and no hit; a null or wordless item matches
    nothing; items without an id mark words but are not named. Repeated rows and
    copies get equal results, repeated item ids count once. With an empty benchmark
    nothing is hit, an empty table gives an empty result, other columns are ignored.
    """
    hits = contaminated_texts(docs, benchmark, text_col, item_col, item_text_col)
    rows = word_counts(docs.select(F.col(id_col).alias("id"), F.md5(F.col(text_col)).alias("key"), F.col(text_col).alias("text")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return rows.join(hits, "key", "left").select(
        F.col("id").alias(id_col), "n_words", zero("n_hit"), zero("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean_texts(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **columns) -> DataFrame:
    """The rows of ``docs`` without a hit, all columns unchanged."""
    hits = small_side(staged(contaminated_texts(docs, benchmark, text_col, **columns).select(F.col("key").alias("leak_key")), "leaks"), 48)
    return docs.join(hits, F.md5(docs[text_col]) == hits["leak_key"], "left_anti")
