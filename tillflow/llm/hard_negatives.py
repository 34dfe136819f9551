"""Hard negatives by exact integer scores from a residue-number-system matrix product.

Vectors become integers. Their components are taken modulo several small primes, the
component matrices are multiplied in float32 (exact while the sums stay below 2**24),
and Chinese remaindering gives each exact signed score. Anchors and rows meet block by
block, every anchor with every row; each pair of blocks passes on only its best rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.text import staged

#: Primes for the residues, largest first: their residues around 0 are below 126, so that
#: 1,000 products of them sum up exactly in float32. All together they hold 95 bits.
PRIMES = [251, 241, 239, 233, 229, 227, 223, 211, 199, 197, 193, 191]
_DEPTH = 1000
#: Rows and anchors of a block, and scores held at once.
ROW_BLOCK, ANCHOR_BLOCK, TILE = 8_192, 16_384, 1 << 20
_LEAST = np.iinfo(np.int64).min


class Residues:
    """Exact products of integer matrices whose scores stay within ``bound``."""

    def __init__(self, bound: int):
        product, self.primes = 1, []
        for p in PRIMES:
            if product > 2 * bound:
                break
            self.primes.append(p)
            product *= p
        if product <= 2 * bound or bound >= 1 << 62:
            raise ValueError("scores do not fit 64 bits")
        self.inverse = [[pow(self.primes[i], -1, self.primes[j]) for i in range(j)] for j in range(len(self.primes))]

    def split(self, x: np.ndarray) -> list[np.ndarray]:
        """The component matrices of an integer matrix: residues around 0, as float32."""
        out = []
        for p in self.primes:
            r = x % p
            out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
        return out

    def product(self, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        """Exact scores of all rows of a with all rows of b."""
        residues = []
        for p, x, y in zip(self.primes, a, b):
            total = np.zeros((len(x), len(y)), np.int32)
            for lo in range(0, max(1, x.shape[1]), _DEPTH):
                total = (total + (x[:, lo : lo + _DEPTH] @ y[:, lo : lo + _DEPTH].T).astype(np.int32)) % p
            residues.append(total)
        # mixed-radix digits: score = d0 + p0 * (d1 + p1 * (d2 + ...)), modulo the product of the primes
        digits: list[np.ndarray] = []
        for j, (p, r) in enumerate(zip(self.primes, residues)):
            for i, d in enumerate(digits):
                r = (r - d) * self.inverse[j][i] % p
            digits.append(r)
        # half of the product has the digits (p - 1) / 2; what is above stands for a negative score
        negative = np.zeros(digits[0].shape, bool)
        for p, d in zip(self.primes, digits):
            negative = np.where(2 * d == p - 1, negative, 2 * d > p - 1)
        out = np.zeros(digits[0].shape, np.int64)
        for p, d in zip(reversed(self.primes), reversed(digits)):
            out = out * p + np.where(negative, d - p + 1, d)
        return out - negative


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows of a matrix; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy().astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = column.flatten().to_numpy()
    return out


def _firsts(scores: np.ndarray, allowed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the n highest allowed scores of each row; of ties, the first columns."""
    if scores.shape[1] > n:
        # the n-th highest, then all above it and as many of its equals as are left
        masked = np.where(allowed, scores, _LEAST)
        cut = np.partition(masked, -n, axis=1)[:, -n][:, None]
        above = masked > cut
        equal = allowed & (masked == cut)
        left = n - above.sum(axis=1, keepdims=True)
        allowed = above | equal & (np.cumsum(equal, axis=1) <= left)
    return np.nonzero(allowed)


def _tiles(anchors: np.ndarray, rows: np.ndarray, residues: Residues):
    """(first anchor, scores) for runs of anchors that fit ``TILE`` scores."""
    a, b = residues.split(anchors), residues.split(rows)
    step = max(1, TILE // max(1, len(rows)))
    for lo in range(0, len(anchors), step):
        yield lo, residues.product([x[lo : lo + step] for x in a], b)


def integer_vectors(rows: DataFrame, anchors: Column, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """id, label, v (array of long: floor(scale * x) of each component as double) and anchor of
    the rows that take part, and ``row``, which tells repeated rows apart."""
    finite = F.forall(F.col(vector_col), lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    usable = F.coalesce(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & finite, F.lit(False))
    scaled = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale))
    columns = [F.col(id_col).alias("id"), F.col(label_col).alias("label"), scaled.alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor")]
    return rows.where(usable).select(*columns, F.monotonically_increasing_id().alias("row"))


def _blocks(rows: DataFrame, n: int, name: str) -> DataFrame:
    return rows.withColumn(name, F.pmod(F.xxhash64("row"), F.lit(n)))


def mine_negatives(
    rows: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    row_block: int = ROW_BLOCK,
    anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """Hard negatives of the rows for which ``anchors`` (a condition on ``rows``) holds.

    A score is the inner product of two rows' integer vectors, floor(scale * x) of each
    component as double; higher ones come first, ties by smaller id. An anchor's
    positives are its first ``positives`` other rows of the same label; for each, the first
    ``negatives`` rows of other labels whose score is between the two percentages of the
    positive's are returned: anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Rows with a null id, label or vector, or a null or non-finite component, take no part.
    Shorter vectors count as ending in zeros, so empty ones score 0. Repeated rows are rows
    of their own: an anchor that is there twice gives its rows twice, and its copy is one of
    its positives. An empty table, no anchors, no positives or no score in the window give no
    rows. Other columns are ignored. Scores that may not fit a long raise ValueError.

    Every anchor meets every row, in blocks of bounded size dealt by hash, so that a hot
    label or vector splits like any other rows. The first pass finds the positives, the second
    the windows that follow from them; both pass on at most the asked number of rows for each
    anchor (or positive) and block.
    """
    spark = rows.sparkSession
    vectors = staged(integer_vectors(rows, anchors, id_col, label_col, vector_col, scale), "negatives")
    id_type = vectors.schema["id"].dataType.simpleString()
    size = vectors.agg(F.count("*"), F.sum(F.col("anchor").cast("long")), F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    out = f"anchor_id {id_type}, positive_id {id_type}, rank int, negative_id {id_type}, positive_score long, negative_score long"
    if not size[1]:
        return spark.createDataFrame([], out)
    width, most = max(size[2], 1), max(-(size[3] or 0), size[4] or 0)
    residues = Residues(width * most * most)
    row_blocks, anchor_blocks = -(-size[0] // row_block), -(-size[1] // anchor_block)

    def dealt(left: DataFrame):
        """Anchors and rows by pairs of blocks: rows once for each block of anchors, and the other way round."""
        a = _blocks(left, anchor_blocks, "ab").withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)).cast("array<bigint>")))
        r = _blocks(vectors.select(*[F.col(c).alias(c) for c in ("id", "label", "v", "row")]), row_blocks, "rb").withColumn("ab", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1)).cast("array<bigint>")))
        return a.groupBy("rb", "ab").cogroup(r.groupBy("rb", "ab"))

    def sorted_by_id(table: pa.Table) -> pa.Table:
        return table.sort_by([("id", "ascending"), ("row", "ascending")])

    def same_label(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[pa.Table] = []
        left, right = left.combine_chunks(), sorted_by_id(right).combine_chunks()
        codes_a, codes_b = _codes(left["label"], right["label"])
        for code in np.unique(codes_a).tolist():
            ours, theirs = np.flatnonzero(codes_a == code), np.flatnonzero(codes_b == code)
            if not len(theirs):
                continue
            some, others = left.take(pa.array(ours)), right.take(pa.array(theirs))
            own, row = some["row"].to_numpy(), others["row"].to_numpy()
            for lo, scores in _tiles(_matrix(some["v"], width), _matrix(others["v"], width), residues):
                i, j = _firsts(scores, own[lo : lo + len(scores), None] != row[None, :], positives)
                found.append(pa.table([some["row"].take(pa.array(i + lo)), others["id"].take(pa.array(j)), others["row"].take(pa.array(j)), pa.array(scores[i, j])], ["row", "positive_id", "positive_row", "positive_score"]))
        return pa.concat_tables(found) if found else none_found

    none_found = pa.table([pa.array([], pa.int64())] * 4, ["row", "positive_id", "positive_row", "positive_score"])
    found = dealt(vectors.where("anchor").drop("anchor")).applyInArrow(same_label, f"row long, positive_id {id_type}, positive_row long, positive_score long")
    first = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    best = staged(found.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= positives).drop("_n"), "negatives")
    # scores s with low * positive <= 100 * s <= high * positive, as whole numbers
    low, high = window
    p = F.col("positive_score").cast("decimal(38,0)")
    lowest, highest = (-F.floor(-p * low / 100)).cast("long"), F.floor(p * high / 100).cast("long")
    asked = best.where(lowest <= highest).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("positive_row", lowest.alias("lo"), highest.alias("hi")))).alias("asked"))
    searching = vectors.where("anchor").drop("anchor").join(asked, "row")

    def in_window(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[pa.Table] = []
        left, right = left.combine_chunks(), sorted_by_id(right).combine_chunks()
        if not len(right):
            return none_in_window
        codes_a, codes_b = _codes(left["label"], right["label"])
        lists = left["asked"].to_pylist()
        for lo, scores in _tiles(_matrix(left["v"], width), _matrix(right["v"], width), residues):
            other = codes_a[lo : lo + len(scores), None] != codes_b[None, :]
            for k in range(max(len(x) for x in lists[lo : lo + len(scores)])):
                here = np.array([i for i in range(len(scores)) if len(lists[lo + i]) > k])
                at = [lists[lo + i][k] for i in here.tolist()]
                bounds = np.array([(x["lo"], x["hi"]) for x in at], np.int64)
                part = scores[here]
                i, j = _firsts(part, other[here] & (part >= bounds[:, :1]) & (part <= bounds[:, 1:]), negatives)
                rows_of = np.array([x["positive_row"] for x in at], np.int64)
                found.append(pa.table([left["row"].take(pa.array(here[i] + lo)), pa.array(rows_of[i]), right["id"].take(pa.array(j)), right["row"].take(pa.array(j)), pa.array(part[i, j])], ["row", "positive_row", "negative_id", "negative_row", "negative_score"]))
        return pa.concat_tables(found) if found else none_in_window

    none_in_window = pa.table([pa.array([], pa.int64())] * 5, ["row", "positive_row", "negative_id", "negative_row", "negative_score"])
    candidates = dealt(searching).applyInArrow(in_window, f"row long, positive_row long, negative_id {id_type}, negative_row long, negative_score long")
    order = Window.partitionBy("row", "positive_row").orderBy(F.desc("negative_score"), "negative_id", "negative_row")
    ranked = candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    names = vectors.where("anchor").select("row", F.col("id").alias("anchor_id"))
    return ranked.join(best, ["row", "positive_row"]).join(names, "row").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _codes(a: pa.ChunkedArray, b: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Labels of any type as numbers, the same for both columns."""
    both = pa.chunked_array([*a.chunks, *b.chunks], a.type).combine_chunks().dictionary_encode()
    codes = (both.combine_chunks() if isinstance(both, pa.ChunkedArray) else both).indices.to_numpy()
    return codes[: len(a)], codes[len(a) :]


def relabelled(embeddings: DataFrame) -> DataFrame:
    """The query's labels: one further, modulo 10, where vec_id is divisible by 7."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return embeddings.withColumn("label", moved)


#: Rank and window the plain way: every anchor's scores by list products.
SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
         CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM usable a JOIN usable r ON a.vec_id <> r.vec_id
  WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 100 * s.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 10"""
