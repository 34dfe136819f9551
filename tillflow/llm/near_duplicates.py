"""Near duplicates: b-bit MinHash signatures in a multi-index Hamming join, links confirmed on full sets.

A signature has HASHES symbols of 8 bits, each the low bits of one min-hash. Two sets
of similarity s differ in about HASHES * (1 - s) symbols; ``distance_limit`` is the
distance that a pair at the threshold exceeds with a chance below one in a million.
The symbols are cut into so many chunks that two signatures within the limit have
some chunk with at most one differing symbol. A chunk stands in the index under
each of its variants with one symbol left out, so that equal keys find every such
pair: all pairs under the limit meet. Pairs that meet are filtered by their exact
signature distance, over these symbols and over CHECK_HASHES more that are not in the
index (each with the same small chance of a miss), and then confirmed on the full
shingle sets. The longer signature tells texts a little below the threshold from
those above it, so a hot group of similar but unlinked texts costs few confirmations.

Equal sets are one class, with one row in everything below. Links are wanted only
up to connection, so no group is expanded into pairs, neither of candidates nor of
links: first each class is compared with a few classes that share whole chunks with
it, which joins the bulk of a group; then each class gets a label, a much shared
chunk, and the classes of a label, and those of each key of the full index with
more than one label, are compared as arrays in a task. So a pair is compared under
its label or under the keys it shares. Only classes with a partner are taken on to
the full sets, and of the links only those that connect what is not connected come
back. The rows are one for each class and one for each of its keys with other labels;
only a label or key with more classes than a block holds is cut into blocks, and its
classes are repeated for each block they are compared with.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.text import LOWER, SPACED, gram_hashes, list_column, mix, ragged, release_memory, small_side, staged, text_key, text_slices, word_hashes, word_spans

HASHES = 128
CHECK_HASHES = 128
ALL_HASHES = HASHES + CHECK_HASHES
SYMBOL_BITS = 8
CHUNK_ERRORS = 1
MISS = 1e-6
#: With how many others each class is compared before the blocks are.
FIRST_CENTERS = 4
#: Classes and set items in a block, as expected; a single larger set is a block's least.
BLOCK_CLASSES, BLOCK_ITEMS = 4096, 1 << 21
#: Index rows and set items that a task compares at once, as expected, and pairs of signatures.
BIN_ROWS, BIN_ITEMS, PAIRS_AT_ONCE = 1 << 15, 1 << 21, 1 << 15
#: Links of up to so many rows are connected in one task, more of them by shuffles.
GATHER_ROWS = 200_000
_RNG = np.random.default_rng(41)
MULTIPLIERS = _RNG.integers(0, 1 << 63, ALL_HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SYMBOL_VALUES = _RNG.integers(0, 1 << 63, (HASHES, 1 << SYMBOL_BITS), dtype=np.uint64)
KEY_SEEDS = _RNG.integers(0, 1 << 63, 2 * HASHES, dtype=np.uint64)
#: Keys have 48 bits: fewer bytes to shuffle; two that are equal by chance cost a comparison.
KEY_SHIFT = np.uint64(16)


def distance_limit(percent: int, hashes: int = HASHES, miss: float = MISS) -> int:
    """Smallest distance that two sets of this similarity exceed with a chance below ``miss``."""
    p = 1 - percent / 100
    tail, limit = 0.0, hashes
    while limit > 0 and tail + comb(hashes, limit) * p**limit * (1 - p) ** (hashes - limit) < miss:
        tail += comb(hashes, limit) * p**limit * (1 - p) ** (hashes - limit)
        limit -= 1
    return limit


def chunk_of(limit: int, hashes: int = HASHES, errors: int = CHUNK_ERRORS) -> np.ndarray:
    """The chunk of each symbol: as few chunks as leave one with at most ``errors``
    of ``limit`` differing symbols (pigeonhole)."""
    chunks = min(hashes, limit // (errors + 1) + 1)
    return np.arange(hashes) * chunks // hashes


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int) -> list[np.ndarray]:
    """Distinct hashes of each text's k-word shingles; a shorter text is one shingle, a wordless one none."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, offs, SPACED)
    words = word_hashes(data, starts, ends)
    grams = gram_hashes(words, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        else:
            out.append(gram_hashes(words[a:b], b - a) if b > a else words[:0])
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ALL_HASHES symbols for each set, zeros for an empty one; the first HASHES stand in the index."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    out = np.zeros((len(sets), ALL_HASHES), np.uint8)
    full = np.flatnonzero(sizes)
    if len(full):
        values = np.concatenate(sets)
        starts = (np.cumsum(sizes) - sizes)[full]
        product = np.empty_like(values)
        for i in range(ALL_HASHES):
            np.multiply(values, MULTIPLIERS[i], out=product)
            out[full, i] = mix(np.minimum.reduceat(product, starts)).astype(np.uint8)
    return out


def bit_planes(symbols: np.ndarray) -> np.ndarray:
    """Each signature as SYMBOL_BITS planes of 64-bit words: bit i of plane b is bit b of symbol i."""
    planes = [np.packbits((symbols >> b) & 1, axis=1, bitorder="little").view("<i8") for b in range(SYMBOL_BITS)]
    return np.concatenate(planes, axis=1)


def signed_documents(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(id, tk, n, cid, sig) of each row: its text's key, set size, class (a hash of the set) and signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_slices(batch.column(2)):
                sets = shingle_sets(data, offs, k)
                sums = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
                sums ^= np.array([np.bitwise_xor.reduce(s) for s in sets], np.uint64) * KEY_SEEDS[0]
                symbols = signatures(sets)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                        pa.array([len(s) for s in sets], pa.int64()), pa.array(mix(sums).view(np.int64)),
                        pa.array([row.tobytes() for row in symbols], pa.binary()),
                    ],
                    ["id", "tk", "n", "cid", "sig"],
                )
        release_memory()  # the worker waits beside others that run

    rows = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tk"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, tk long, n long, cid long, sig binary")


def index_keys(classes: DataFrame, chunk: np.ndarray, errors: int) -> DataFrame:
    """Rows (pos, key, cid, comp) for (cid, comp, sig): one for each chunk (errors 0), or
    one for each symbol, with that symbol left out of its chunk (errors 1)."""
    starts = np.flatnonzero(np.diff(chunk, prepend=-1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols = signature_matrix(batch.column(2))[:, :HASHES]
            for i in range(0, len(symbols), 2000):
                terms = SYMBOL_VALUES[np.arange(HASHES), symbols[i : i + 2000]]
                totals = np.add.reduceat(terms, starts, axis=1)
                keys = totals[:, chunk] - terms + KEY_SEEDS[:HASHES] if errors else totals + KEY_SEEDS[HASHES : HASHES + len(starts)]
                lists = list_column(pa.array((mix(keys.reshape(-1)) >> KEY_SHIFT).view(np.int64)), np.full(len(terms), keys.shape[1]))
                yield pa.record_batch([batch.column(0).slice(i, len(terms)), batch.column(1).slice(i, len(terms)), lists], ["cid", "comp", "keys"])

    # each class becomes many rows: small tasks, so that none spills
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = classes.select("cid", "comp", "sig").repartition(parts).mapInArrow(run, "cid long, comp long, keys array<long>")
    return rows.select(F.posexplode("keys").alias("pos", "key"), "cid", "comp")


def signature_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), ALL_HASHES)


def mixed_buckets(rows: DataFrame) -> DataFrame:
    """The rows (key, cid, comp, ...) whose key stands in more than one component, with the key's number of rows (classes)."""
    mixed = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("classes")).filter("lo < hi")
    return rows.join(small_side(staged(mixed.select("key", "classes"), "near_mixed"), 24), "key")


def star_pairs(rows: DataFrame, seed: int, centers: int) -> DataFrame:
    """Pairs (a, b) of classes of different components from the index rows: each key
    names one of its classes by a hash, and each class a of a smaller component is
    paired with the ``centers`` classes that its keys name most often, which are
    similar ones as a rule."""
    sizes = rows.select("cid", "comp").distinct().groupBy("comp").agg(F.count("*").alias("size"))
    sized = rows.join(sizes, "comp")
    named = sized.groupBy("key").agg(F.max(F.struct(F.xxhash64("cid", "key", F.lit(seed)).alias("h"), "cid", F.struct("size", "comp").alias("rank"))).alias("c"))
    smaller = F.struct("size", "comp") < F.col("c.rank")
    met = sized.join(named, "key").filter(smaller).groupBy("cid", F.col("c.cid").alias("b")).agg(F.count("*").alias("times"))
    place = F.row_number().over(Window.partitionBy("cid").orderBy(F.desc("times"), F.xxhash64("b", F.lit(seed))))
    return met.withColumn("place", place).filter(F.col("place") <= centers).select(F.col("cid").alias("a"), "b")


def full_sets(wanted: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(cid, items): the shingle sets of the wanted classes (cid), from one text of each."""
    wanted = staged(wanted.join(classes.select("cid", "id", "tk"), "cid"), "near_wanted").withColumnsRenamed({"id": "wid", "tk": "wtk"})
    rows = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tk"), F.col(text_col).alias("text"))
    texts = rows.join(small_side(wanted, 40), rows["id"].eqNullSafe(F.col("wid")) & (rows["tk"] == F.col("wtk"))).select("cid", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_slices(batch.column(1)):
                sets = shingle_sets(data, offs, k)
                values = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), list_column(pa.array(values), np.array([len(s) for s in sets]))], ["cid", "items"])
        release_memory()

    return texts.mapInArrow(run, "cid long, items array<long>").dropDuplicates(["cid"])


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar."""
    sets = full_sets(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), classes, docs, id_col, text_col, k)
    left, right = sets.withColumnsRenamed({"cid": "a", "items": "xs"}), sets.withColumnsRenamed({"cid": "b", "items": "ys"})
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("xs", "ys"))
    return both.filter(shared * 100 >= (F.size("xs") + F.size("ys") - shared) * percent).select("a", "b")


def components(edges: DataFrame, gather_rows: int | None = None) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b), root the smallest node
    connected with it, by alternating large-star and small-star steps until nothing changes.

    The steps are joins and grouped minima. While the counted edges are few, they
    stand in one partition and need no exchange; with more they are shuffled.
    """
    limit = GATHER_ROWS if gather_rows is None else gather_rows

    def toward_least(sym: DataFrame, keep: Column) -> DataFrame:
        least = sym.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        return sym.join(least, "u").filter(keep)

    current = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v"), "near_edges")
    state = None
    while True:
        now = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        if now[0] <= limit:
            current = current.coalesce(1)
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        both = both.coalesce(1) if now[0] <= limit else both
        large = toward_least(both, F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = toward_least(large, F.lit(True))
        small = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        small = small.coalesce(1) if now[0] <= limit else small
        current = staged(small.filter("u <> v").distinct(), "near_edges")


def labelled(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` with ``comp``: the smallest class connected with it."""
    roots = components(links)
    return classes.join(roots, classes["cid"] == roots["node"], "left").select(*[classes[c] for c in classes.columns], F.coalesce("root", "cid").alias("comp"))


def with_labels(grouped: DataFrame, shared: DataFrame) -> DataFrame:
    """``grouped`` with ``label``, the same for the classes of a component: a chunk (key of the rows
    ``shared``) that many classes share, found through the most shared one of each component,
    or the component's own number if it shares none with another."""
    rows = staged(mixed_buckets(shared.select("key", "cid").join(grouped.select("cid", "comp"), "cid")), "near_chunks")
    tops = staged(rows.groupBy("comp").agg(F.max(F.struct("classes", "key")).alias("top")), "near_tops")
    best = rows.join(tops, "comp").groupBy("key").agg(F.max("top").alias("best"))
    labels = tops.select("comp", F.col("top.key").alias("key")).join(best, "key").select("comp", F.col("best.key").alias("label"))
    return grouped.join(labels, "comp", "left").withColumn("label", F.coalesce("label", "comp"))


def to_compare(marked: DataFrame, chunk: np.ndarray) -> DataFrame:
    """(key, cid): what is compared with each other, the classes of each label with more than one
    component and those of each key of the full index with more than one label. All two classes
    of different components that share a key have a label or that key in common."""
    mixed = marked.groupBy("label").agg((F.min("comp") < F.max("comp")).alias("mixed")).filter("mixed")
    within = marked.join(mixed, "label").select(F.col("label").alias("key"), "cid")
    across = mixed_buckets(index_keys(marked.select("cid", F.col("label").alias("comp"), "sig"), chunk, 1))
    return within.unionByName(across.select("key", "cid"))


def in_blocks(rows: DataFrame) -> DataFrame:
    """The rows (key, cid, n, ..) with (x, y, part): the classes of a key are dealt to as many blocks
    (part) as their number and items ask for, one as a rule, and stand in each pair x <= y of
    blocks that their own is in."""
    size = F.greatest(F.count("*") / BLOCK_CLASSES, F.sum("n") / BLOCK_ITEMS)
    parts = rows.groupBy("key").agg(F.ceil(size).cast("int").alias("parts")).filter("parts > 1")
    rows = rows.join(small_side(staged(parts, "near_wide"), 12), "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.withColumns({"x": F.least("part", "other"), "y": F.greatest("part", "other")}).drop("parts", "other")


class Block:
    """Classes of a block as arrays: planes, set sizes, component numbers."""

    def __init__(self, planes: np.ndarray, n: np.ndarray, comp: np.ndarray):
        self.planes, self.n, self.comp = planes, n, comp

    def near(self, other: Block, limit: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
        """(first row, matrix of which of the next rows are near which rows of ``other``): of different
        components, of similar sizes, and within the limits of the index's symbols and of all."""
        words, step = ALL_HASHES // 64, max(1, PAIRS_AT_ONCE // max(1, len(other.n)))
        for lo in range(0, len(self.n), step):
            mine = slice(lo, lo + step)
            small, large = np.minimum.outer(self.n[mine], other.n), np.maximum.outer(self.n[mine], other.n)
            fits = (small * 100 >= large * percent) & (self.comp[mine, None] != other.comp)
            if not fits.any():
                continue
            counts = np.zeros(fits.shape, np.int64)
            for part in range(words):
                differ = np.zeros(fits.shape, np.uint64)
                for plane in range(part, words * SYMBOL_BITS, words):
                    differ |= np.bitwise_xor.outer(self.planes[mine, plane], other.planes[:, plane])
                counts += np.bitwise_count(differ)
                if part == HASHES // 64 - 1:
                    fits &= counts <= limit
                    if not fits.any():
                        break
            else:
                yield lo, fits & (counts <= distance_limit(percent, ALL_HASHES))


def _runs(*columns: np.ndarray) -> np.ndarray:
    """The end of the run of equal rows that each row of the sorted columns is in."""
    new = np.flatnonzero(reduce(np.logical_or, [np.diff(c) != 0 for c in columns])) + 1
    ends = np.append(new, len(columns[0]))
    return np.repeat(ends, np.diff(ends, prepend=0))


def near_rows(rows: pa.Table, limit: int, percent: int) -> np.ndarray:
    """Which rows (key, x, y, part, comp, n, p, ..) have a partner: under the same key in the other block,
    of another component and of similar size, within the limits of signatures."""
    key, x, y, part, comp = (rows[c].to_numpy() for c in ("key", "x", "y", "part", "comp"))
    order = np.lexsort((comp, part, y, x, key))
    key, x, y, part, comp = (c[order] for c in (key, x, y, part, comp))
    every = _blocks(rows)
    n, planes = every.n[order], np.ascontiguousarray(every.planes[order].T)
    end = _runs(key, x, y)
    start = np.where(x == y, _runs(key, x, y, comp), np.where(part == x, _runs(key, x, y, part), end))
    before = np.append(0, np.cumsum(end - start))
    near, words, limit_all = np.zeros(len(order), bool), ALL_HASHES // 64, distance_limit(percent, ALL_HASHES)
    lo = 0
    while lo < len(order):
        hi = max(lo + 1, int(np.searchsorted(before, before[lo] + PAIRS_AT_ONCE, "right")) - 1)
        counts = (end - start)[lo:hi]
        a, b = np.repeat(np.arange(lo, hi), counts), ragged(start[lo:hi], counts)
        fits = (np.minimum(n[a], n[b]) * 100 >= np.maximum(n[a], n[b]) * percent) & (comp[a] != comp[b])
        a, b, distance = a[fits], b[fits], np.zeros(int(fits.sum()), np.int64)
        for word in range(words):
            distance += np.bitwise_count(reduce(np.bitwise_or, [plane[a] ^ plane[b] for plane in planes[word::words]]))
            if word == HASHES // 64 - 1:
                fits = distance <= limit
                a, b, distance = a[fits], b[fits], distance[fits]
        fits = distance <= limit_all
        near[a[fits]] = near[b[fits]] = True
        lo = hi
    return np.sort(order[near])


def _block_pairs(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of the two blocks of each (key, x, y) in a table (key, x, y, part, ..)."""
    key, x, y, part = (rows[c].to_numpy() for c in ("key", "x", "y", "part"))
    order = np.lexsort((part, y, x, key))
    cuts = np.unique(_runs(key[order], x[order], y[order])).tolist()
    for lo, hi in zip([0, *cuts], cuts):
        at = order[lo:hi]
        if x[at[0]] == y[at[0]]:
            yield at, at
        else:
            first = part[at] == x[at[0]]
            yield at[first], at[~first]


def _blocks(rows: pa.Table) -> Block:
    planes = rows["p"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(rows.num_rows, SYMBOL_BITS * ALL_HASHES // 64)
    return Block(planes, rows["n"].to_numpy(), rows["comp"].to_numpy())


def _at(block: Block, rows: np.ndarray) -> Block:
    return Block(block.planes[rows], block.n[rows], block.comp[rows])


def new_links(one: Block, two: Block, ids_one: list[np.ndarray], ids_two: list[np.ndarray], limit: int, percent: int) -> list[tuple[int, int]]:
    """Links (row in one, row in two) of similar sets that connect the components, without rings.
    The sets are arrays of numbers from 0."""
    sizes = np.array([len(s) for s in ids_two], np.int64)
    starts, flat = np.cumsum(sizes) - sizes, np.concatenate(ids_two)
    inside = np.zeros(1 + max(int(flat.max()), max(int(s.max()) for s in ids_one)), bool)
    _, numbers = np.unique(np.concatenate([one.comp, two.comp]), return_inverse=True)
    mine, others = numbers[: len(one.comp)], numbers[len(one.comp) :]
    out = []
    for lo, near in one.near(two, limit, percent):
        for i, row in enumerate(near, lo):
            found = np.flatnonzero(row)
            found = found[others[found] != mine[i]]
            if not len(found):
                continue
            inside[ids_one[i]] = True
            counts = sizes[found]
            shared = np.add.reduceat(inside[flat[ragged(starts[found], counts)]], np.cumsum(counts) - counts, dtype=np.int64)
            inside[ids_one[i]] = False
            for j in found[shared * 100 >= (len(ids_one[i]) + counts - shared) * percent].tolist():
                if others[j] != mine[i]:
                    out.append((i, j))
                    old = others[j]
                    mine[mine == old], others[others == old] = mine[i], mine[i]
    return out


def new_class_links(members: DataFrame, planes: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int, limit: int, percent: int) -> DataFrame:
    """Links (a, b) of classes, confirmed on full sets, that connect all similar classes which share
    a key (members) and are not in one component yet; for each two blocks fewer than their classes."""
    least = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(rows: DataFrame, bins: int) -> DataFrame:
        return rows.withColumn("bin", F.pmod(F.xxhash64("key", "x", "y"), F.lit(max(least, bins))))

    def with_partners(rows: pa.Table) -> pa.Table:
        return rows.select(["key", "x", "y", "part", "cid"]).take(pa.array(near_rows(rows, limit, percent)))

    def linked(rows: pa.Table) -> pa.Table:
        every, items = _blocks(rows), rows["items"].combine_chunks()
        values, offs = items.flatten().to_numpy(), np.r_[0, np.cumsum(items.value_lengths().to_numpy())]
        links, cids = [], rows["cid"].to_numpy()
        for a, b in _block_pairs(rows):
            if not len(a) or not len(b):
                continue
            used = np.unique(np.r_[a, b])
            _, numbers = np.unique(np.concatenate([values[offs[r] : offs[r + 1]] for r in used]), return_inverse=True)
            sets = dict(zip(used.tolist(), np.split(numbers, np.cumsum(offs[used + 1] - offs[used])[:-1])))
            links += [(cids[a[i]], cids[b[j]]) for i, j in new_links(_at(every, a), _at(every, b), [sets[r] for r in a.tolist()], [sets[r] for r in b.tolist()], limit, percent)]
        return pa.table([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])

    near = dealt(in_blocks(members.join(planes, "cid")), members.count() // BIN_ROWS)
    near = staged(near.groupBy("bin").applyInArrow(with_partners, "key long, x int, y int, part int, cid long"), "near_partners")
    sets = full_sets(near.select("cid").distinct(), classes, docs, id_col, text_col, k)
    near = near.join(planes, "cid")
    near = dealt(near, near.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // BIN_ITEMS)
    return near.join(sets, "cid").groupBy("bin").applyInArrow(linked, "a long, b long")


def first_meeting(low: Column, high: Column, chunk: np.ndarray) -> Column:
    """The first index position at which two signatures meet that differ in these symbols."""
    cases = None
    for c in range(chunk[-1] + 1):
        inside = [int(i) for i in np.flatnonzero(chunk == c)]
        masks = [sum(1 << (i - 64 * half) for i in inside if i // 64 == half) for half in (0, 1)]
        parts = [(word.bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)), 64 * half) for half, (word, m) in enumerate(zip((low, high), masks)) if m]
        differing = reduce(lambda x, y: x + y, [F.bit_count(part) for part, _ in parts])
        # without a difference they meet at all symbols of the chunk; with one, where it is left out
        # (the place of the one bit set; the sign bit has no value below it)
        zeros = lambda part: F.coalesce(F.bit_count(F.try_subtract(part, F.lit(1)).bitwiseAND(F.bitwise_not(part))), F.lit(63))
        place = F.coalesce(*[F.when(part != 0, zeros(part) + base) for part, base in parts])
        cases = (F if cases is None else cases).when(differing == 0, F.lit(inside[0])).when(differing == 1, place)
    return cases


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """(id, tk, n, grp, component) for every row: set size, group and the group's smallest id.

    Rows are linked if their sets of ``k``-word shingles share at least ``percent``
    percent of their union (A-Z lower-cased; words by ASCII white space), and a group
    is what links connect. Texts without words are linked with nothing and are their
    own component. A null id takes part in links and is named only if its group has
    no other id. Rows may repeat; ``tk`` tells rows of one id and different texts apart.
    """
    limit = distance_limit(percent)
    chunk = chunk_of(limit)
    signed = staged(signed_documents(docs, id_col, text_col, k), "near_signed")
    classes = signed.filter("n > 0").groupBy("cid").agg(F.min(F.struct("id", "tk")).alias("r"), F.min("id").alias("least"), F.any_value("n").alias("n"), F.any_value("sig").alias("sig"))
    classes = staged(classes.select("cid", "r.id", "r.tk", "least", "n", "sig"), "near_classes")

    # each class with some that share whole chunks
    keys = index_keys(classes.withColumn("comp", F.col("cid")), chunk, 0).drop("pos")
    shared = staged(mixed_buckets(keys), "near_shared")
    stars = staged(star_pairs(shared, 0, FIRST_CENTERS), "near_stars")
    links = staged(confirmed(stars, classes, docs, id_col, text_col, k, percent), "near_links")

    # what meets in the index and is not connected yet
    grouped = staged(labelled(classes.select("cid", "sig", "n"), links), "near_grouped")
    marked = staged(with_labels(grouped, shared), "near_labels")
    members = staged(to_compare(marked, chunk), "near_members")
    met = marked.join(members.select("cid").distinct(), "cid", "left_semi").select("cid", "comp", "n", "sig")
    planes = staged(met.mapInArrow(_plane_rows, "cid long, comp long, n long, p array<long>"), "near_planes")
    links = links.unionByName(new_class_links(members, planes, classes, docs, id_col, text_col, k, limit, percent))

    final = staged(labelled(classes.select("cid", "least"), links), "near_final")
    names = final.groupBy("comp").agg(F.min("least").alias("component"))
    named = final.join(names, "comp").select(F.col("cid").alias("ccid"), F.col("comp").alias("grp"), "component")
    rows = signed.select("id", "tk", "n", F.when(F.col("n") > 0, F.col("cid")).alias("ccid"))
    return rows.join(named, "ccid", "left").select("id", "tk", "n", "grp", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component"))


def _plane_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        planes = bit_planes(signature_matrix(batch.column(3)))
        lists = list_column(pa.array(planes.reshape(-1)), np.full(batch.num_rows, planes.shape[1]))
        yield pa.record_batch([*batch.columns[:3], lists], ["cid", "comp", "n", "p"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_shingles, component_id, kept (the id is the
    component's). See ``near_duplicate_groups``; an empty table gives an empty result, other
    columns are ignored."""
    groups = near_duplicate_groups(docs, id_col, text_col, k, percent)
    return groups.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the row with the smallest
    id stays, and of its exact repetitions one; wordless texts all stay. Columns are unchanged."""
    groups = staged(near_duplicate_groups(docs, id_col, text_col, k, percent).filter("n > 0"), "near_groups")
    stay = groups.filter(F.col("id").eqNullSafe(F.col("component"))).groupBy("grp").agg(F.min(F.struct("id", "tk")).alias("stay"))
    rows = groups.groupBy("id", "tk").agg(F.any_value("grp").alias("grp"), F.count("*").alias("times"))
    rated = rows.join(stay, "grp").withColumn("stays", F.struct("id", "tk").eqNullSafe(F.col("stay")))
    rated = staged(rated.filter("not stays or times > 1").select(F.struct("id", "tk").alias("near_key"), "stays"), "near_rated")
    key = F.struct(docs[id_col].alias("id"), text_key(docs[text_col]).alias("tk"))
    touched, repeated = small_side(rated, 40), small_side(rated.filter("stays"), 40)
    others = docs.join(touched, key.eqNullSafe(touched["near_key"]), "left_anti")
    again = docs.join(repeated, key.eqNullSafe(repeated["near_key"])).dropDuplicates(["near_key"]).select(*[docs[c] for c in docs.columns])
    return others.unionByName(again)
