"""URL lists joined as of the fetch time, in DataFrame operations only.

Dated list entries (added, removed) become validity intervals. A capture is looked
up under its host, the host's parent domains and its path prefixes, and meets an
entry only if the entry was valid when the capture was fetched. The join is by
(kind, pattern, time bucket): an interval stands in each bucket that it touches, so
a host or domain with a third of all captures is split by time, and no pair of a
capture and an entry of another time is made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKET_SECONDS = 7 * 86400


def host_of(url: Column) -> Column:
    """Lower-cased host without user, port and final dot; "" where there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.regexp_replace(host, r"\.$", "")


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def domains(host: Column) -> Column:
    """The host and its parent domains; empty without a host."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.when(F.length(host) > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."))).otherwise(F.array().cast("array<string>"))


def prefixes(host: Column, path: Column, depth: int, stubs: list[int]) -> Column:
    """``host/``, ``host/a/``, ... down to ``depth`` path folders (entries have no more),
    each also with as many characters of what follows up to the next "/" as ``stubs`` has."""
    whole = F.split(path, "/")
    parts = F.slice(whole, 1, depth + 1)
    n = F.size(parts) - F.when(F.size(whole) > depth + 1, 0).otherwise(1)
    folder = lambda i: F.concat(host, F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))

    def cut(i: Column) -> Column:
        fitting = F.filter(F.array(*map(F.lit, stubs)), lambda k: k <= F.length(F.get(whole, i)))
        return F.transform(fitting, lambda k: F.concat(folder(i), F.left(F.get(whole, i), k)))

    places = F.sequence(F.lit(1), n)
    found = F.concat(F.transform(places, folder), F.flatten(F.transform(places, cut))) if stubs else F.transform(places, folder)
    return F.when((F.length(host) > 0) & (n > 0), found).otherwise(F.array().cast("array<string>"))


def entry_intervals(entries: DataFrame) -> DataFrame:
    """Entries (list, kind, pattern, action, at) as intervals (list, kind, pattern, valid_from, valid_to).

    ``action`` is "add" or "remove"; an entry is valid from its addition up to, not
    including, the next entry of the same list, kind and pattern (null: still valid).
    If it is added and removed at one time, it is added. Repeated entries count once;
    rows with a null in any of these columns are no entries. Patterns are compared
    in lower case for domains and for the host of path prefixes, whose path is taken
    as it stands. A prefix may end anywhere in a path; one without "/" is a whole host.
    """
    host = F.substring_index("pattern", "/", 1)
    path = F.right("pattern", F.length("pattern") - F.length(host))
    pattern = F.when(F.col("kind") == "domain", F.lower("pattern")).otherwise(F.concat(F.lower(host), path))
    dated = (
        entries.select("list", "kind", pattern.alias("pattern"), "action", "at").dropna()
        .groupBy("list", "kind", "pattern", "at").agg(F.max(F.col("action") == "add").alias("added"))
    )
    later = F.lead("at").over(Window.partitionBy("list", "kind", "pattern").orderBy("at"))
    return dated.select("list", "kind", "pattern", "added", F.col("at").alias("valid_from"), later.alias("valid_to")).filter("added").drop("added")


def filter_urls(captures: DataFrame, entries: DataFrame, url_col: str = "url", at_col: str = "fetched_at") -> DataFrame:
    """All rows and columns of ``captures`` and host, n_block, n_allow, blocked.

    n_block and n_allow count the entries of the lists "block" and "allow" that match
    the URL and were valid at its fetch time; a capture is blocked if it has one of
    the first and none of the second. A null or relative URL has the host "" and
    matches nothing, nor does one without a fetch time. Repeated captures get equal
    verdicts, empty tables give no row or no match; columns of ``captures`` with
    these four names are replaced.
    """
    own = captures.drop("host", "n_block", "n_allow", "blocked")
    url, at = F.col(url_col), F.col(at_col)
    valid = entry_intervals(entries)
    last_part = F.when(F.contains("pattern", F.lit("/")), F.length(F.substring_index("pattern", "/", -1)))
    shape = F.max(F.size(F.split("pattern", "/")) - 2), F.collect_set(last_part), F.coalesce(F.max(last_part.isNull()), F.lit(False))
    depth, stubs, hosts_only = valid.filter("kind = 'prefix'").agg(*shape).first()
    seen = own.select(url.alias("u"), at.alias("t")).dropna().distinct()
    last = seen.agg(F.max("t")).first()[0]
    bucket = lambda t: F.floor(F.unix_timestamp(t) / BUCKET_SECONDS)
    host, path = host_of(F.col("u")), path_of(F.col("u"))
    keys = F.transform(domains(host), lambda p: F.struct(F.lit("domain").alias("kind"), p.alias("pattern")))
    if depth is not None:
        asked_prefixes = prefixes(host, path, max(depth, 0), sorted(set(stubs) - {0}))
        if hosts_only:
            asked_prefixes = F.concat(asked_prefixes, F.filter(F.array(host), lambda h: F.length(h) > 0))
        keys = F.concat(keys, F.transform(asked_prefixes, lambda p: F.struct(F.lit("prefix").alias("kind"), p.alias("pattern"))))
    asked = seen.select("u", "t", bucket(F.col("t")).alias("bucket"), F.explode(keys).alias("k")).select("u", "t", "bucket", "k.*")
    end = F.coalesce(F.col("valid_to"), F.lit(last)) if last is not None else F.col("valid_to")
    touched = valid.filter(F.col("valid_from") <= F.lit(last)).select(
        "*", F.explode(F.sequence(bucket(F.col("valid_from")), bucket(F.least(end, F.lit(last))))).alias("bucket")
    )
    active = (F.col("t") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("t") < F.col("valid_to")))
    found = asked.join(touched, ["kind", "pattern", "bucket"]).filter(active).groupBy("u", "t").agg(
        F.count_if(F.col("list") == "block").alias("n_block"), F.count_if(F.col("list") == "allow").alias("n_allow")
    )
    verdict = found.select(F.struct("u", "t").alias("k"), F.struct("n_block", "n_allow").alias("v"))
    key = F.struct(url.alias("u"), at.alias("t"))
    out = own.alias("c").join(verdict, key == F.col("k"), "left")
    count = lambda f: F.coalesce(F.col(f"v.{f}"), F.lit(0))
    return out.select(
        "c.*", F.coalesce(host_of(url), F.lit("")).alias("host"), count("n_block").alias("n_block"), count("n_allow").alias("n_allow"),
        ((count("n_block") > 0) & (count("n_allow") == 0)).alias("blocked"),
    )


# --- the registered query: captures and dated entries derived from ``pages`` -----------------


def page_captures(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url) with a fetch time: an hour of 2024 and 2025 that follows from page_id."""
    return pages.select("page_id", "url", F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col("page_id") * 7919, F.lit(731 * 24)) * 3600).alias("fetched_at"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """A dated list whose entries come from the hosts, parent domains and path folders of ``pages``.

    The hash of a pattern says whether it is listed, when it is added and removed,
    and whether it comes back; a quarter of the hosts and parent domains are in the
    block list, half of the first path folders in the allow list.
    """
    host = host_of(F.col("url"))
    folder = F.get(F.split(path_of(F.col("url")), "/"), F.lit(1))
    entry = lambda name, kind, pattern: F.struct(F.lit(name).alias("list"), F.lit(kind).alias("kind"), pattern.alias("pattern"))
    patterns = pages.select(F.explode(F.array(
        entry("block", "domain", host),
        entry("block", "domain", F.regexp_replace(host, r"^[^.]*\.(?=.*\..*\.)", "")),
        entry("allow", "prefix", F.concat(host, F.lit("/"), folder, F.lit("/"))),
    )).alias("e")).select("e.*").filter(F.length("pattern") > 0).distinct()
    part = lambda a, n: F.conv(F.substring(F.md5("pattern"), a, n), 16, 10).cast("long")
    listed = patterns.filter(part(1, 1) < F.when(F.col("list") == "block", 4).otherwise(8))
    day = lambda d: F.timestamp_seconds(F.lit(1704067200) + d * 86400)
    first, off, back = part(2, 3) % 300, part(5, 3) % 200 + 1, part(8, 3) % 150 + 1
    dated = lambda action, at: F.struct(F.lit(action).alias("action"), at.alias("at"))
    return listed.select("list", "kind", "pattern", F.explode(F.array(
        dated("add", day(first)),
        dated("remove", F.when(part(11, 1) > 2, day(first + off))),
        dated("add", F.when(part(11, 1) > 7, day(first + off + back))),
    )).alias("a")).select("list", "kind", "pattern", "a.*").filter(F.col("at").isNotNull())


#: The registered query in DuckDB SQL, over ``pages``.
SQL = r"""
WITH c AS (
  SELECT page_id, url, make_timestamp((1704067200 + (page_id * 7919 % (731 * 24)) * 3600) * 1000000) AS fetched_at,
         regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '\.$', '') AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), p AS (
  SELECT 'block' AS list, 'domain' AS kind, host AS pattern FROM c
  UNION SELECT 'block', 'domain', CASE WHEN len(string_split(host, '.')) > 3 THEN substr(host, strpos(host, '.') + 1) ELSE host END FROM c
  UNION SELECT 'allow', 'prefix', host || '/' || string_split(path, '/')[2] || '/' FROM c
), h AS (
  SELECT *, ('0x' || substr(md5(pattern), 1, 1))::BIGINT AS pick, ('0x' || substr(md5(pattern), 2, 3))::BIGINT % 300 AS first,
         ('0x' || substr(md5(pattern), 5, 3))::BIGINT % 200 + 1 AS off, ('0x' || substr(md5(pattern), 8, 3))::BIGINT % 150 + 1 AS back,
         ('0x' || substr(md5(pattern), 11, 1))::BIGINT AS more
  FROM p WHERE length(pattern) > 0
), v AS (
  SELECT list, kind, pattern, first AS a, CASE WHEN more > 2 THEN first + off END AS z FROM h WHERE pick < CASE list WHEN 'block' THEN 4 ELSE 8 END
  UNION ALL
  SELECT list, kind, pattern, first + off + back, NULL FROM h WHERE more > 7 AND pick < CASE list WHEN 'block' THEN 4 ELSE 8 END
), t AS (
  SELECT list, kind, pattern, make_timestamp((1704067200 + a * 86400) * 1000000) AS valid_from,
         make_timestamp((1704067200 + z * 86400) * 1000000) AS valid_to FROM v
), m AS (
  SELECT page_id, list FROM c JOIN t ON kind = 'domain' AND (host = pattern OR ends_with(host, '.' || pattern))
    AND fetched_at >= valid_from AND (valid_to IS NULL OR fetched_at < valid_to)
  UNION ALL
  SELECT page_id, list FROM c JOIN t ON kind = 'prefix' AND starts_with(host || path, pattern)
    AND fetched_at >= valid_from AND (valid_to IS NULL OR fetched_at < valid_to)
), n AS (
  SELECT page_id, count(*) FILTER (list = 'block') AS n_block, count(*) FILTER (list = 'allow') AS n_allow FROM m GROUP BY page_id
)
SELECT page_id, url, fetched_at, coalesce(host, '') AS host, coalesce(n_block, 0)::BIGINT AS n_block, coalesce(n_allow, 0)::BIGINT AS n_allow,
       coalesce(n_block, 0) > 0 AND coalesce(n_allow, 0) = 0 AS blocked
FROM c LEFT JOIN n USING (page_id)
"""
