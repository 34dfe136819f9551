"""Quality rules with cross-document line frequency, in DataFrame operations only.

Each line is normalised (A-Z lower-cased, white space runs to one space, trimmed)
and hashed; per host the distinct texts that hold it are counted. Lines above the
host's limit are removed, and a text that loses too large a share of its words is
rejected, as is one that fails the base rules. A text's copies on a host count
once, and near copies that share nearly all their lines about once, so neither turn
their own lines into boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.text import small_side, staged

#: Fixed values of the base rules.
GAP = "[ \\t-\\r]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), F.lit(""))


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(line, UPPER, LOWER), GAP, " "))


def word_lines(text: Column) -> Column:
    """The \\n-split lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))


def with_metrics(docs: DataFrame, text: Column, name: str) -> DataFrame:
    """``docs`` with one struct column ``name``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Each step is a projection of its own, so that no expression is evaluated twice;
    the sorting of windows runs only for texts that repeat one.
    """
    n = F.col(f"{name}.n_words")
    step = docs.withColumn(name, F.struct(text.alias("text"), words_of(text).alias("words"), word_lines(text).alias("lines")))
    c = lambda field: F.col(f"{name}.{field}")
    step = step.withColumn(name, F.struct(
        F.transform(c("words"), lambda w: F.xxhash64(w)).alias("hashes"),
        F.size(c("words")).cast("long").alias("n_words"),
        F.length(F.array_join(c("words"), "")).cast("long").alias("word_chars"),
        F.regexp_count(c("text"), F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long").alias("n_dup_lines"),
    ))
    counts = [c(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines")]
    from_here = F.transform(c("hashes"), lambda h, i: F.xxhash64(h, *[F.get(c("hashes"), i + j) for j in range(1, WINDOW)]))
    step = step.withColumn(name, F.struct(*counts, F.when(n >= WINDOW, from_here).alias("windows")))
    step = step.withColumn(name, F.struct(*counts, F.slice(c("windows"), F.lit(1), (n - WINDOW + 1).cast("int")).alias("windows")))
    repeats = F.size(F.array_distinct(c("windows"))) < F.size(c("windows"))
    ordered = F.when(repeats, F.array_sort(F.transform(c("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    step = step.withColumn(name, F.struct(*counts, ordered.alias("ordered")))
    near = lambda i: F.get(c("ordered"), i)["h"]
    found = F.filter(c("ordered"), lambda x, i: F.coalesce(near(i - 1) == x["h"], F.lit(False)) | F.coalesce(near(i + 1) == x["h"], F.lit(False)))
    starts = F.array_sort(F.transform(found, lambda x: x["i"]))
    step = step.withColumn(name, F.struct(*counts, starts.alias("starts")))
    covered = F.aggregate(
        c("starts"),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("total")),
        lambda a, s: F.struct((s + WINDOW).alias("end"), (a["total"] + s + WINDOW - F.greatest(s, a["end"])).alias("total")),
        lambda a: a["total"],
    )
    return step.withColumn(name, F.struct(*counts, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")))


def removed_lines(docs: DataFrame, host: Column, text: Column, max_share: float, min_docs: int, min_left: float) -> DataFrame:
    """For each (host, text) with lines above the limit: their hashes and the words they take.

    A line is above the limit if more than ``min_docs`` and more than ``max_share``
    of the host's distinct texts hold it. Texts that such lines would leave with less
    than the share ``min_left`` of their words may be near copies of each other: they
    are counted again as one text for each smallest hash of their lines above the
    limit, so a line goes only if it recurs in otherwise different texts.

    Each text's line hashes are written once, as arrays, one row for each distinct text
    of a host. Counting is by partial sums, so a host or a line with a third of all rows
    is combined before it is shuffled. Single lines don't move: a host has at most
    (lines of a text) / ``max_share`` lines above the limit on average, and these are
    broadcast to the arrays if their counted rows fit (else Spark shuffles, with the same
    result).
    """
    line = F.filter(F.transform(F.split("text", "\n"), normal_line), lambda x: x != "")
    rows = docs.select(host.alias("host"), F.unhex(F.md5(text)).alias("tid"), text.alias("text")).select("host", "tid", line.alias("lines"))
    arrays = F.struct(
        F.transform("lines", lambda x: F.xxhash64(x)).alias("h"),
        F.transform("lines", lambda x: F.size(F.split(x, " "))).alias("n"),
    )
    texts = rows.select("host", "tid", arrays.alias("l")).groupBy("host", "tid").agg(F.any_value("l").alias("l"))
    texts = staged(texts.select("host", "tid", "l.h", "l.n"), "quality_texts")
    hosts = texts.groupBy("host").agg(F.count("*").alias("n_texts"))

    def above(counted: DataFrame) -> DataFrame:
        counted = counted.filter(F.col("n_docs") > min_docs).join(hosts, "host")
        return counted.filter(F.col("n_docs") > F.col("n_texts") * max_share).select("host", "h")

    counted = texts.select("host", F.explode(F.array_distinct("h")).alias("h")).groupBy("host", "h").agg(F.count("*").alias("n_docs"))
    frequent = small_side(staged(above(counted), "quality_frequent"), 64)
    words = F.aggregate("n", F.lit(0).cast("long"), lambda total, x: total + x)
    hits = (
        texts.select("host", "tid", words.alias("words"), F.inline(F.arrays_zip("h", "n")))
        .join(frequent, ["host", "h"]).groupBy("host", "tid")
        .agg(F.collect_list(F.struct("h", "n")).alias("lines"), F.sum("n").alias("n"), F.any_value("words").alias("words"))
    )
    smallest = F.unhex(F.hex(F.array_min("lines.h")))
    depleted = F.col("words") - F.col("n") < F.col("words") * min_left
    hits = staged(hits.select("host", "tid", "lines", F.when(depleted, smallest).otherwise(F.col("tid")).alias("context")), "quality_hits")
    contexts = hits.select("host", "context", F.explode("lines.h").alias("h")).distinct()
    sure = small_side(staged(above(contexts.groupBy("host", "h").agg(F.count("*").alias("n_docs"))), "quality_lines"), 64)
    return (
        hits.select("host", "tid", F.inline("lines")).join(sure, ["host", "h"]).groupBy("host", "tid")
        .agg(F.collect_set("h").alias("hashes"), F.sum("n").cast("long").alias("n_removed_words"))
    )


def assess(docs: DataFrame, text_col: str = "text", host_col: str = "source", max_share: float = 0.05, min_docs: int = 10, min_left: float = 0.3) -> tuple[DataFrame, str]:
    """All rows and columns of ``docs`` and one struct column, whose name is returned too:
    the counts of ``with_metrics``, base_failed, n_removed_words, hashes (of the
    removed lines, null without any) and kept.

    Kept is false for a text that fails the base rules, or of whose words less than
    the share ``min_left`` is left without the removed lines. A null text counts as
    an empty one, a null host as the host "". Repeated rows get equal verdicts, an
    empty table stays empty, and columns of any names pass unchanged.
    """
    name = free_name(docs, "quality")
    text, host = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(host_col).cast("string"), F.lit(""))
    removed = removed_lines(docs, host, text, max_share, min_docs, min_left).select(F.struct("host", "tid").alias("key"), F.struct("hashes", "n_removed_words").alias("removed"))
    removed = removed.withColumnsRenamed({"key": f"{name}_key", "removed": f"{name}_removed"})
    own = docs.withColumn(f"{name}_key", F.struct(host.alias("host"), F.unhex(F.md5(text)).alias("tid")))
    joined = with_metrics(own, text, name).join(removed, f"{name}_key", "left")
    q = lambda field: F.col(f"{name}.{field}")
    n_removed = F.coalesce(F.col(f"{name}_removed.n_removed_words"), F.lit(0))
    failed = (q("n_words") < MIN_WORDS) | (q("n_repeat_words") * 100 > q("n_words") * MAX_REPEAT_PERCENT)
    depleted = (q("n_words") - n_removed) < q("n_words") * min_left
    out = joined.withColumn(name, F.struct(
        f"{name}.*", failed.alias("base_failed"), n_removed.alias("n_removed_words"),
        F.col(f"{name}_removed.hashes").alias("hashes"), (~failed & ~depleted).alias("kept"),
    ))
    return out.select(*docs.columns, name), name


def quality_rules(docs: DataFrame, id_col: str = "doc_id", **limits) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, the counts, base_failed, n_removed_words and kept (see ``assess``)."""
    rated, q = assess(docs, **limits)
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_words", "kept"]
    return rated.select(F.col(id_col), *[F.col(f"{q}.{f}").alias(f) for f in fields])


def kept_texts(docs: DataFrame, text_col: str = "text", host_col: str = "source", chars_col: str | None = None, **limits) -> DataFrame:
    """The rows of ``docs`` that are kept, without their removed lines; texts that lose
    none are unchanged. ``chars_col``, if given, gets the new number of characters.

    The verdicts are written first: a filter on them would be pushed down into the
    counts and evaluate them many times over.
    """
    rated, q = assess(docs, text_col=text_col, host_col=host_col, **limits)
    text, host = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(host_col).cast("string"), F.lit(""))
    key = F.struct(host.alias("host"), F.unhex(F.md5(text)).alias("tid"))
    verdicts = staged(rated.select(key.alias("rated_key"), F.col(f"{q}.kept").alias("kept"), F.col(f"{q}.hashes").alias("hashes")), "quality_verdicts")
    rejected = small_side(verdicts.filter("not kept").select("rated_key").distinct(), 64)
    shortened = small_side(verdicts.filter("kept and hashes is not null").groupBy("rated_key").agg(F.any_value("hashes").alias("gone")), 256)
    line_kept = lambda x: ~F.array_contains("gone", F.xxhash64(normal_line(x)))
    cleaned = F.array_join(F.filter(F.split(docs[text_col], "\n"), line_kept), "\n")
    own_key = F.struct(F.coalesce(docs[host_col].cast("string"), F.lit("")).alias("host"), F.unhex(F.md5(F.coalesce(docs[text_col], F.lit("")))).alias("tid"))
    kept = docs.join(rejected, own_key == rejected["rated_key"], "left_anti").join(shortened, own_key == shortened["rated_key"], "left")
    out = F.when(F.col("gone").isNull(), docs[text_col]).otherwise(cleaned)
    chars = lambda c: F.when(F.col("gone").isNull(), docs[c]).otherwise(F.length(cleaned).cast(docs.schema[c].dataType))
    return kept.select(*[out.alias(c) if c == text_col else chars(c).alias(c) if c == chars_col else docs[c] for c in docs.columns])


#: The same rows in DuckDB SQL, over ``documents``.
SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), win AS (
  SELECT r, i, array_to_string(words[i:i+7], ' ') AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w)
), hit AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM win) WHERE n > 1
), rep AS (
  SELECT r, count(*) AS n FROM (SELECT DISTINCT r, i + j AS p FROM hit, range(0, 8) t(j)) GROUP BY r
), l AS (
  SELECT r, host, text, trim(regexp_replace(translate(line, '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+', ' ', 'g')) AS line
  FROM (SELECT r, host, text, unnest(lines) AS line FROM w)
), above AS (
  SELECT c.host, c.line FROM (SELECT host, line, count(DISTINCT text) AS n FROM l GROUP BY host, line) c
  JOIN (SELECT host, count(DISTINCT text) AS n FROM d GROUP BY host) h USING (host)
  WHERE c.n > 10 AND c.n > h.n * 0.05
), gone AS (
  SELECT r, sum(len(string_split(line, ' '))) AS n FROM l JOIN above USING (host, line) GROUP BY r
), m AS (
  SELECT r, doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS n_removed_words
  FROM w LEFT JOIN rep USING (r) LEFT JOIN gone USING (r)
), f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       n_removed_words::BIGINT AS n_removed_words, NOT base_failed AND n_words - n_removed_words >= n_words * 0.3 AS kept
FROM f
"""
