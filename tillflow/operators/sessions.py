"""Gap-based user sessions over a batch of events, safe for a hot user.

A session of one user is a maximal run of events, in time order, in which each
event follows the one before it by less than ``gap``. Two events exactly one gap
apart start different sessions (half-open windows ``[t, t + gap)`` that only
touch do not merge). A session's window is ``[first, last + gap)``; it is named
by the id of its oldest event, ties in time broken by the smaller id.

Plan, built so that no user's rows ever go to one task:

1. ``repartitionByRange(P, user, ts, id, position)`` + ``sortWithinPartitions``.
   The range bounds come from a sample, so a user holding a third of all rows
   (or a third of all rows being copies of one event) is cut into many
   consecutive partitions, each about 1/P of the data. This is the only
   shuffle of event rows.
2. ``mapInArrow`` walks each sorted partition once, vectorised per Arrow batch,
   carrying only the open session across batches. It emits one *fragment* per
   local session (or the events tagged with their fragment, and at the end of the
   partition a summary of its first and last fragment). Memory is one batch, and
   ids, keys and extra columns never leave Arrow, so nulls and large integers stay.
3. The scan's output is written once to the shared folder, in the scan's order (a
   column tells edges from the rest). Only the first and the last fragment of a partition can continue across
   a partition edge, so at most ``2P`` *edge* fragments are stitched with a window
   over the user's edges (a user spanning m partitions has at most 2m edges) and
   summed; inner fragments are already whole sessions and are not shuffled at all.
   Prices are added as whole numbers on a fixed grid (``functions.sums``), so that totals
   have the same bits however the rows are cut into partitions and batches.
4. For per-event results, each continued fragment (at most ``P - 1`` rows, a
   bound fixed by the plan, not by the data) is broadcast back to the events.

Spark's own ``session_window`` in batch clusters every row of a user into one
task before merging; that is why it is not used here. It is used on streams
(``tillflow.streaming``), where each micro-batch is bounded.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tillflow.functions.sums import PARTS, joined, joined_of, parts_of
from tillflow.functions.time import micros, ntz_micros, window_max_timestamp

# Fixed value: the session gap of the reference job.
SESSION_GAP = "10 minutes"


def gap_micros(gap: str | int) -> int:
    """A gap as microseconds: an int is taken as microseconds, text as a Spark interval."""
    if isinstance(gap, int):
        return gap
    return _parse_interval_micros(gap)


_UNITS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def _parse_interval_micros(text: str) -> int:
    parts = text.strip().lower().split()
    if len(parts) % 2:
        raise ValueError(f"interval must be '<n> <unit> ...', got {text!r}")
    total = 0
    for num, unit in zip(parts[::2], parts[1::2]):
        unit = unit.rstrip("s")
        if unit not in _UNITS:
            raise ValueError(f"unknown interval unit {unit!r} in {text!r}")
        total += int(float(num) * _UNITS[unit])
    return total


def _narrow(events: DataFrame, key: str, time_col: str, id_col: str, price_col: str,
            extra: tuple[str, ...]) -> DataFrame:
    ts_type = events.schema[time_col].dataType
    t = F.col(time_col)
    if isinstance(ts_type, T.TimestampNTZType):
        t_us = ntz_micros(t)
    else:
        t_us = micros(t)
    # ``dup`` tells exact copies apart (same user, time and id), so that even a
    # third of all rows being copies of one event splits over many partitions. It
    # comes from the row's input position, so a retried task gets the same value.
    return events.where(F.col(key).isNotNull() & t.isNotNull()).select(
        F.col(key).alias("k"),
        t_us.alias("t_us"),
        F.col(id_col).alias("eid"),
        F.monotonically_increasing_id().alias("dup"),
        # A null price counts as 0, as sum() skips nulls; NaN stays NaN.
        F.coalesce(F.col(price_col).cast("double"), F.lit(0.0)).alias("p"),
        *extra,
    )


def _time_of(us: Column, ntz: bool) -> Column:
    """Microseconds back to the input's own time type (instant, or UTC wall clock)."""
    if ntz:
        return F.timestamp_add("MICROSECOND", us, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return F.timestamp_micros(us)


def _is_ntz(events: DataFrame, time_col: str) -> bool:
    return isinstance(events.schema[time_col].dataType, T.TimestampNTZType)


def _ranged(narrow: DataFrame, partitions: int | None) -> DataFrame:
    """Range-partition and sort by (user, time, id); ``pid`` follows the global order.

    Without ``partitions`` the count is ``spark.sql.shuffle.partitions`` and AQE
    may coalesce small partitions; it only merges adjacent ranges, so partition
    ids stay in global order, which is all the stitching needs.
    """
    keys = ("k", "t_us", "eid", "dup")
    ranged = narrow.repartitionByRange(partitions, *keys) if partitions else narrow.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys).drop("dup").withColumn("pid", F.spark_partition_id())


def _segments(k: pa.Array, t: np.ndarray, gap_us: int, carry) -> tuple[np.ndarray, bool]:
    """Start offsets of the local sessions in one sorted batch, and whether the first continues ``carry``."""
    n = len(t)
    new = np.ones(n, dtype=bool)
    if n > 1:
        other = pc.not_equal(k.slice(1), k.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new[1:] = other | ((t[1:] - t[:-1]) >= gap_us)
    cont = carry is not None and k[0] == carry["k"] and (t[0] - carry["last_t"]) < gap_us
    return np.flatnonzero(new), cont


def _one(value: pa.Scalar) -> pa.Array:
    """A one-row array of a scalar's own type."""
    return pa.array([value.as_py()], value.type) if not pa.types.is_decimal(value.type) else pa.array([value])


def _columns(batch: pa.RecordBatch, *names: str) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(n)) for n in names]


#: The summed parts of a total; ``total`` (or ``frag_running``) beside them holds what is outside their grid.
_SUMS = [f"sum{j}" for j in range(PARTS)]
_FRAG_COLS = ["pid", "lsid", "k", "first_t", "last_t", "first_eid", "n", "total", "edge", *_SUMS]


def _fragment_batch(pid: int, rows: list[tuple]) -> pa.RecordBatch:
    """Fragments (lsid, k, first_t, last_t, first_eid, n, total, edge, summed parts) whose columns are arrays, one after the other."""
    joined = [pa.concat_arrays([r[i] if isinstance(r[i], pa.Array) else pa.array(r[i]) for r in rows]) for i in range(len(rows[0]))]
    return pa.record_batch([pa.array(np.full(len(joined[0]), pid, np.int32)), *joined], _FRAG_COLS)


def _fragment_scan(gap_us: int):
    """Per sorted partition: one row per local session (fragment); ``edge`` on its first and last."""

    def closed(c: dict, edge: bool) -> tuple:
        return (np.array([c["lsid"]]), _one(c["k"]), np.array([c["first_t"]]), np.array([c["last_t"]]), _one(c["first_eid"]),
                np.array([c["n"]]), np.array([c["total"]]), np.array([edge]), *c["sums"].reshape(PARTS, 1))

    def run(batches):
        carry = None  # the fragment still open at the end of the previous batch
        next_lsid = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            k, e, t, p, pids = _columns(batch, "k", "eid", "t_us", "p", "pid")
            pid, t, p = pids[0].as_py(), t.to_numpy(), p.to_numpy()
            starts, cont = _segments(k, t, gap_us, carry)
            ends = np.r_[starts[1:], len(t)]
            cut, beside = parts_of(p)
            sums, tot = np.add.reduceat(cut, starts, axis=1), np.add.reduceat(beside, starts)
            first = int(cont)
            if cont:
                carry["last_t"] = int(t[ends[0] - 1])
                carry["n"] += int(ends[0])
                carry["total"] += float(tot[0])
                carry["sums"] = carry["sums"] + sums[:, 0]
            m = len(starts) - first
            if m == 0:
                continue
            rows = [] if carry is None else [closed(carry, carry["lsid"] == 0)]
            lsid = np.arange(next_lsid, next_lsid + m)
            next_lsid += m
            if m > 1:
                idx, end = starts[first:-1], ends[first:-1]
                at = pa.array(idx)
                rows.append((lsid[:-1], k.take(at), t[idx], t[end - 1], e.take(at), end - idx, tot[first:-1], lsid[:-1] == 0, *sums[:, first:-1]))
            if rows:
                yield _fragment_batch(pid, rows)
            last = int(starts[-1])
            carry = {"lsid": int(lsid[-1]), "k": k[last], "first_t": int(t[last]), "last_t": int(t[-1]), "first_eid": e[last],
                     "n": len(t) - last, "total": float(tot[-1]), "sums": sums[:, -1].copy()}
        if carry is not None:
            yield _fragment_batch(pid, [closed(carry, True)])

    return run


#: Rows of the event scan: events, summaries of a partition's first and last fragment, of the others.
_EVENT, _EDGE, _WHOLE = 0, 1, 2
_EVENT_COLS = ["pid", "lsid", "k", "t_us", "eid", "p", "frag_first_t", "frag_first_eid", "frag_pos", "frag_running", "kind", *_SUMS]


def _event_scan(gap_us: int, extra: tuple[str, ...], closings: bool):
    """Per sorted partition: every event tagged with its fragment, position and running
    total; with ``closings`` a summary of each inner fragment, a whole session, once it has ended; at
    the end one of the partition's first and last fragment. In a summary the event columns
    hold the fragment's last time, size and total. Totals that may continue one of the partition
    before are left as summed parts, the others have none."""
    names = [*_EVENT_COLS, *extra]

    def summary(kind: int, pid: int, lsid, k: pa.Array, last_t, first_t, first_e: pa.Array, n, total, sums: list, kinds: list) -> pa.RecordBatch:
        m = len(k)
        return pa.record_batch(
            [pa.array(np.full(m, pid, np.int32)), pa.array(lsid), k, pa.array(last_t), pa.nulls(m, first_e.type), pa.array(np.zeros(m)), pa.array(first_t),
             first_e, pa.array(n), pa.array(total), pa.array(np.full(m, kind, np.int8)), *(sums or [pa.nulls(m, pa.int64())] * PARTS), *[pa.nulls(m, t) for t in kinds]],
            names,
        )

    def ended(kind: int, pid: int, c: dict, kinds: list) -> pa.RecordBatch:
        one = [np.array([c[x]]) for x in ("lsid", "last_t", "first_t", "n", "total")]
        sums = c["sums"].reshape(PARTS, 1)
        total, left = (one[4], list(map(pa.array, sums))) if kind == _EDGE else (joined_of(sums) + one[4], [])
        return summary(kind, pid, one[0], _one(c["k"]), one[1], one[2], _one(c["first_eid"]), one[3], total, left, kinds)

    def run(batches):
        carry = None
        lsid = -1
        head_edge = None  # the first fragment, once it has ended
        kinds = []
        for batch in batches:
            if not batch.num_rows:
                continue
            k, e, t, p, pids = _columns(batch, "k", "eid", "t_us", "p", "pid")
            passing = _columns(batch, *extra)
            kinds = [c.type for c in passing]
            pid, t, values = pids[0].as_py(), t.to_numpy(), p.to_numpy()
            starts, cont = _segments(k, t, gap_us, carry)
            seg_no = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(t)]))
            frag = (lsid if cont else lsid + 1) + seg_no
            pos = np.arange(len(t)) - starts[seg_no] + 1
            cut, beside = parts_of(values)
            # a NaN price stays in its session's total from then on
            running = pd.Series(beside).groupby(seg_no).cumsum(skipna=False).to_numpy(copy=True) if np.any(beside) else beside
            sums = np.cumsum(cut, axis=1)
            sums -= np.where(starts > 0, sums[:, starts - 1], 0)[:, seg_no]
            first_t = t[starts][seg_no]
            first_e = e.take(pa.array(starts[seg_no]))
            if cont:
                head = seg_no == 0
                pos[head] += carry["n"]
                running[head] += carry["total"]
                sums[:, head] += carry["sums"][:, None]
                first_t[head] = carry["first_t"]
                first_e = pa.concat_arrays([_one(carry["first_eid"]), e]).take(pa.array(np.where(head, 0, starts[seg_no] + 1)))
            if carry is not None and carry["lsid"] == 0 and (not cont or len(starts) > 1):
                done = int(starts[1]) - 1 if cont else None
                head_edge = carry if done is None else _fragment_end(0, k, t, first_t, first_e, pos, running, sums, done)
            elif carry is None and len(starts) > 1:
                head_edge = _fragment_end(0, k, t, first_t, first_e, pos, running, sums, int(starts[1]) - 1)
            total = joined_of(sums) + running
            open_left = frag == 0  # may continue the partition before
            yield pa.record_batch(
                [pids, pa.array(frag), k, pa.array(t), e, p, pa.array(first_t), first_e, pa.array(pos), pa.array(np.where(open_left, running, total)),
                 pa.array(np.full(len(t), _EVENT, np.int8)), *[pa.array(x, mask=~open_left) for x in sums], *passing],
                names,
            )
            if closings:
                if carry is not None and not cont and carry["lsid"] > 0:
                    yield ended(_WHOLE, pid, carry, kinds)
                last = starts[1:] - 1  # all fragments but the batch's last have ended here
                last = last[frag[last] > 0]
                if len(last):
                    at = pa.array(last)
                    yield summary(_WHOLE, pid, frag[last], k.take(at), t[last], first_t[last], first_e.take(at), pos[last], total[last], [], kinds)
            lsid = int(frag[-1])
            carry = _fragment_end(lsid, k, t, first_t, first_e, pos, running, sums, len(t) - 1)
        if carry is None:
            return
        for c in [carry] if head_edge is None else [head_edge, carry]:
            yield ended(_EDGE, pid, c, kinds)

    return run


def _fragment_end(lsid: int, k: pa.Array, t, first_t, first_e: pa.Array, pos, running, sums, at: int) -> dict:
    """A fragment as its last event in this batch shows it."""
    return {"lsid": lsid, "k": k[at], "last_t": int(t[at]), "first_t": int(first_t[at]), "first_eid": first_e[at], "n": int(pos[at]), "total": float(running[at]), "sums": sums[:, at].copy()}


def _fragment_schema(narrow: DataFrame) -> T.StructType:
    s = narrow.schema
    kinds = [T.IntegerType(), T.LongType(), s["k"].dataType, T.LongType(), T.LongType(), s["eid"].dataType, T.LongType(), T.DoubleType(), T.BooleanType(), *[T.LongType()] * PARTS]
    return T.StructType([T.StructField(c, kind) for c, kind in zip(_FRAG_COLS, kinds)])


def _event_schema(narrow: DataFrame, extra: tuple[str, ...]) -> T.StructType:
    s = narrow.schema
    fields = [
        T.StructField("pid", T.IntegerType()),
        T.StructField("lsid", T.LongType()),
        T.StructField("k", s["k"].dataType),
        T.StructField("t_us", T.LongType()),
        T.StructField("eid", s["eid"].dataType),
        T.StructField("p", T.DoubleType()),
        T.StructField("frag_first_t", T.LongType()),
        T.StructField("frag_first_eid", s["eid"].dataType),
        T.StructField("frag_pos", T.LongType()),
        T.StructField("frag_running", T.DoubleType()),
        T.StructField("kind", T.ByteType()),
        *[T.StructField(c, T.LongType()) for c in _SUMS],
    ]
    return T.StructType(fields + [T.StructField(c, s[c].dataType) for c in extra])


def _staged_scan(ranged: DataFrame, scan, schema: T.StructType) -> DataFrame:
    """The scan's output written once as Parquet, in its order and without another sort. A
    lost executor repeats no scan; readers filter by the row kind, which Parquet's statistics prune."""
    from tillflow.runtime import scratch_path

    path = scratch_path(ranged.sparkSession, "session_scan")
    ranged.mapInArrow(scan, schema).write.parquet(path)
    return ranged.sparkSession.read.schema(schema).parquet(path)


def _edge_chains(edges: DataFrame, gap_us: int, partition_by: list[Column]) -> DataFrame:
    """Edge fragments with ``cont`` (continues the previous fragment) and ``chain`` (session number).

    A fragment continues the one before it (same user, an earlier partition) when
    it is first in its partition and starts less than ``gap`` after that
    fragment's last event. Only edges need this test: inside a partition the
    scan has already split sessions.
    """
    order = Window.partitionBy(*partition_by).orderBy("pid", "lsid")
    prev_last = F.lag("last_t").over(order)
    cont = (F.col("lsid") == 0) & prev_last.isNotNull() & ((F.col("first_t") - prev_last) < F.lit(gap_us))
    edges = edges.withColumn("cont", F.coalesce(cont, F.lit(False)))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return edges.withColumn("chain", F.sum(F.when(F.col("cont"), 0).otherwise(1)).over(upto))


def _session_rows(k: Column, first_t: Column, first_eid: Column, last_t: Column, n: Column, total: Column,
                  gap_us: int, ntz: bool) -> list[Column]:
    return [
        k.alias("user_id"),
        first_eid.alias("window_id"),
        _time_of(first_t, ntz).alias("window_start"),
        _time_of(last_t + F.lit(gap_us), ntz).alias("window_end"),
        _time_of(last_t, ntz).alias("last_event_time"),
        total.alias("total_price"),
        n.alias("event_count"),
    ]


def sessions(
    events: DataFrame,
    gap: str | int = SESSION_GAP,
    key: str = "user_id",
    time_col: str = "ts",
    id_col: str = "event_id",
    price_col: str = "price",
    partitions: int | None = None,
) -> DataFrame:
    """One row per session: user_id, window_id, window_start, window_end (exclusive,
    last event + gap), last_event_time, total_price (double, in the same bits at every partitioning), event_count.

    Rows with a null key or time are not sessionised. The scan's fragments are
    written once; inner fragments are final sessions (no shuffle), edge
    fragments (at most two per range partition) are chained with a window per
    user and summed.
    """
    gap_us = gap_micros(gap)
    ntz = _is_ntz(events, time_col)
    narrow = _narrow(events, key, time_col, id_col, price_col, ())
    scanned = _staged_scan(_ranged(narrow, partitions), _fragment_scan(gap_us), _fragment_schema(narrow))
    whole, edges = scanned.where(~F.col("edge")), scanned.where(F.col("edge"))
    # Inner fragments are whole sessions: no shuffle.
    inner = whole.select(
        *_session_rows(F.col("k"), F.col("first_t"), F.col("first_eid"), F.col("last_t"), F.col("n"),
                       joined([F.col(c) for c in _SUMS]) + F.col("total"), gap_us, ntz)
    )
    # Edge fragments (at most two per partition) are chained per user.
    chained = _edge_chains(edges, gap_us, [F.col("k")])
    upto = Window.partitionBy("k").orderBy("pid", "lsid").rowsBetween(Window.unboundedPreceding, 0)
    chained = chained.withColumn(
        "head", F.last(F.when(~F.col("cont"), F.struct("first_t", "first_eid")), ignorenulls=True).over(upto)
    )
    stitched = (
        chained.groupBy("k", "chain", F.col("head.first_t").alias("head_t"), F.col("head.first_eid").alias("head_eid"))
        .agg(F.max("last_t").alias("last_t"), F.sum("n").alias("n"), (joined([F.sum(c) for c in _SUMS]) + F.sum("total")).alias("total"))
        .select(
            *_session_rows(F.col("k"), F.col("head_t"), F.col("head_eid"), F.col("last_t"),
                           F.col("n"), F.col("total"), gap_us, ntz)
        )
    )
    return inner.unionByName(stitched)


def session_event_rows(
    events: DataFrame,
    gap: str | int = SESSION_GAP,
    key: str = "user_id",
    time_col: str = "ts",
    id_col: str = "event_id",
    price_col: str = "price",
    extra: tuple[str, ...] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Every event with its session: user_id, window_id, window_start, event_id, ts,
    price, position (1-based, in (time, id) order) and running_total (sum so far).

    ``extra`` columns of the events are carried through. The tagged scan output is
    written once to the shared folder, with summaries of the edge fragments behind the events.
    """
    ntz = _is_ntz(events, time_col)
    scanned, edges = _event_parts(events, gap_micros(gap), key, time_col, id_col, price_col, tuple(extra), partitions, False)
    return _event_rows(scanned, edges, key, time_col, id_col, price_col, tuple(extra), ntz)


def _event_parts(events: DataFrame, gap_us: int, key: str, time_col: str, id_col: str, price_col: str, extra: tuple[str, ...],
                 partitions: int | None, closings: bool) -> tuple[DataFrame, DataFrame]:
    """The written event scan, and its edges with what the fragments before them in their session add up to."""
    narrow = _narrow(events, key, time_col, id_col, price_col, extra)
    scanned = _staged_scan(_ranged(narrow, partitions), _event_scan(gap_us, extra, closings), _event_schema(narrow, extra))
    edges = scanned.where(F.col("kind") == _EDGE).select(
        "pid", "lsid", "k", F.col("frag_first_t").alias("first_t"), F.col("t_us").alias("last_t"), F.col("frag_pos").alias("n"),
        F.col("frag_running").alias("total"), *_SUMS, F.struct(F.col("frag_first_t").alias("t_us"), F.col("frag_first_eid").alias("eid")).alias("head"),
    )
    chain_w = Window.partitionBy("k", "chain").orderBy("pid", "lsid")
    before = chain_w.rowsBetween(Window.unboundedPreceding, -1)
    return scanned, (
        _edge_chains(edges, gap_us, [F.col("k")])
        .withColumn("off_n", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumns({f"off_{c}": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in _SUMS})
        .withColumn("off_total", F.coalesce(F.sum("total").over(before), F.lit(0.0)))
        .withColumn("chain_head", F.first("head").over(chain_w.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("ends", F.lead("pid").over(chain_w).isNull())
    )


def _event_rows(scanned: DataFrame, edges: DataFrame, key: str, time_col: str, id_col: str, price_col: str, extra: tuple[str, ...], ntz: bool) -> DataFrame:
    moved = edges.where(F.col("cont")).select("pid", "lsid", "off_n", "off_total", *[f"off_{c}" for c in _SUMS], F.col("chain_head.t_us").alias("h_first_t"), F.col("chain_head.eid").alias("h_first_eid"))
    moved = F.broadcast(moved)  # only first fragments of partitions: at most P - 1 rows
    joined = scanned.where(F.col("kind") == _EVENT).join(moved, ["pid", "lsid"], "left")
    return joined.select(
        F.col("k").alias(key),
        F.when(F.col("h_first_t").isNull(), F.col("frag_first_eid")).otherwise(F.col("h_first_eid")).alias("window_id"),  # an id may be null
        _time_of(F.coalesce(F.col("h_first_t"), F.col("frag_first_t")), ntz).alias("window_start"),
        F.col("eid").alias(id_col),
        _time_of(F.col("t_us"), ntz).alias(time_col),
        F.col("p").alias(price_col),
        (F.col("frag_pos") + F.coalesce(F.col("off_n"), F.lit(0))).alias("position"),
        F.when(F.col(_SUMS[0]).isNull(), F.col("frag_running")).otherwise(_with_offsets("frag_running")).alias("running_total"),
        *extra,
    )


def _with_offsets(total: str) -> Column:
    """A fragment's total with what the fragments before it add up to, if there are any."""
    sums = joined([F.col(c) + F.coalesce(F.col(f"off_{c}"), F.lit(0)) for c in _SUMS])
    return sums + F.col(total) + F.coalesce(F.col("off_total"), F.lit(0.0))


def _open_panes(rows: DataFrame, key: str, time_col: str) -> DataFrame:
    return rows.select(
        "window_id",
        F.col(key).alias("user_id"),
        "window_start",
        F.col(time_col).alias("window_end"),
        F.col("running_total").cast("float").alias("total_price"),
        F.lit(True).alias("window_open"),
        F.col("position").alias("event_count"),
    )


def running_totals(
    events: DataFrame,
    gap: str | int = SESSION_GAP,
    key: str = "user_id",
    time_col: str = "ts",
    id_col: str = "event_id",
    price_col: str = "price",
    partitions: int | None = None,
) -> DataFrame:
    """The open pane after each event, as a batch: the session so far (window_id,
    window_start, newest time as window_end, running total as float, event count)."""
    rows = session_event_rows(events, gap_micros(gap), key, time_col, id_col, price_col, partitions=partitions)
    return _open_panes(rows, key, time_col)


def session_panes(
    events: DataFrame,
    gap: str | int = SESSION_GAP,
    key: str = "user_id",
    time_col: str = "ts",
    id_col: str = "event_id",
    price_col: str = "price",
    partitions: int | None = None,
) -> DataFrame:
    """Batch view of the stream's output: the open pane after each event, and one
    closed pane per session.

    Open pane: window_end is the newest event time so far, total the running sum.
    Closed pane: window_end is the window's last instant, end - 1 ms.
    ``total_price`` is summed in double and narrowed to float.
    """
    gap_us, ntz = gap_micros(gap), _is_ntz(events, time_col)
    scanned, edges = _event_parts(events, gap_us, key, time_col, id_col, price_col, (), partitions, True)
    open_panes = _open_panes(_event_rows(scanned, edges, key, time_col, id_col, price_col, (), ntz), key, time_col)
    # Closed panes: the scan has summed up inner sessions; of those over partition edges the
    # last fragment has what the others add up to. No event row is shuffled or grouped again.
    inner = scanned.where(F.col("kind") == _WHOLE).select(
        "k", F.col("frag_first_eid").alias("eid"), F.col("frag_first_t").alias("first"), F.col("t_us").alias("last"), F.col("frag_running").alias("total"), F.col("frag_pos").alias("n")
    )
    over_edges = edges.where("ends").select(
        "k", F.col("chain_head.eid").alias("eid"), F.col("chain_head.t_us").alias("first"), F.col("last_t").alias("last"),
        _with_offsets("total").alias("total"), (F.col("n") + F.col("off_n")).alias("n"),
    )
    closed = inner.unionByName(over_edges).select(
        F.col("eid").alias("window_id"),
        F.col("k").alias("user_id"),
        _time_of(F.col("first"), ntz).alias("window_start"),
        window_max_timestamp(_time_of(F.col("last") + F.lit(gap_us), ntz)).alias("window_end"),
        F.col("total").cast("float").alias("total_price"),
        F.lit(False).alias("window_open"),
        F.col("n").alias("event_count"),
    )
    return open_panes.unionByName(closed)
