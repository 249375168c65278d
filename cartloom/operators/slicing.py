"""Time slicing and paging (WIN1-WIN7, FLT8, SRT3, FUN7).

The service is asked slice by slice: a day is cut into fixed slices (15 min for
orders, 1 h for customers); a slice holding ``cap`` or more records is refined
down a ladder of widths to 1 s; an over-full second is paged (or, for orders in
``compat`` mode, cut to ``cap``). Here the whole ladder is one aggregation:

1. count records per second (a partial aggregate, so any hot key is reduced
   map-side; a second holds one row per group afterwards, 86,400 per day at most);
2. roll the 1-s counts up to every level with window sums whose partition keys
   all start with the coarsest slice, so one exchange serves every level and a
   window partition never holds more than ``width0`` rows;
3. each second takes the coarsest level whose count is under ``cap``; the chosen
   slices are the distinct (level, start) pairs.

``compat=True`` reproduces what the reference's requests would capture: the day
ends at 23:59:59 (closed), a refined last slice loses its tail (``int(899/300)``
sub-slices), and orders over ``cap`` in one second are cut to ``cap``.
Refinement decisions count half-open slices (a stamp exactly on a boundary is
counted once, in the later slice), or with ``closed=True`` the closed ranges that
the requests ask for: a stamp exactly on a boundary counts in both neighbours, and
:func:`closed_capture` returns it from both requests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.functions.timefmt import add_seconds, floor_to, seconds_between
from cartloom.operators.conform import ref
from cartloom.schemas import ORDER_LADDER, PAGE_SIZE
from cartloom.session import ensure_checkpoint_dir

DAY = 86400


def _cols(names: Sequence[str]) -> list[Column]:
    return [ref(n) for n in names]


# --------------------------------------------------------------------------
# Fixed grids (WIN1, WIN2)
# --------------------------------------------------------------------------
def fixed_slices(df: DataFrame, ts: str, width_seconds: int = 900,
                 by: Sequence[str] = ()) -> DataFrame:
    """Non-empty fixed tumbling slices with their record counts (WIN1/WIN2, FLT8).

    Columns: ``by..., slice_start, slice_end, n``. Empty slices produce no row.
    """
    w = F.window(ref(ts), f"{int(width_seconds)} seconds")
    return (df.groupBy(*_cols(by), w.alias("w"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(*_cols(by), F.col("w.start").alias("slice_start"),
                    F.col("w.end").alias("slice_end"), "n"))


def slice_grid(days: DataFrame, day_col: str, width_seconds: int,
               closed_day_end: bool = False) -> DataFrame:
    """The literal grid of a day: ``DAY / width`` slices per day (WIN1).

    ``closed_day_end`` ends the last slice at 23:59:59 as the reference's lists do.
    Row count = days x slices per day, fixed by the calendar.
    """
    start = F.to_date(ref(day_col)).cast("timestamp_ntz")
    n = DAY // int(width_seconds)
    grid = days.select(ref(day_col), start.alias("_d"),
                       F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    s = add_seconds(F.col("_d"), F.col("i") * int(width_seconds))
    e = add_seconds(F.col("_d"), (F.col("i") + 1) * int(width_seconds))
    if closed_day_end:
        e = F.when(F.col("i") == n - 1, add_seconds(F.col("_d"), DAY - 1)).otherwise(e)
    return grid.select(ref(day_col), F.col("i").alias("slice_no"), s.alias("slice_start"),
                       e.alias("slice_end"))


def sub_slices(spans: DataFrame, start: str, end: str, width_seconds: int,
               keep: Sequence[str] = ()) -> DataFrame:
    """Cut each ``[start, end]`` into ``int((end - start) / width)`` parts (FUN7).

    As in the reference, a span that is not a multiple of ``width`` loses its
    tail (23:45:00-23:59:59 in 300 s parts gives 2 parts). Columns:
    ``keep..., start, end, n_parts, part_no, part_start, part_end``.
    """
    w = int(width_seconds)
    n_parts = F.floor(seconds_between(ref(start), ref(end)) / F.lit(w)).cast("int")
    parts = F.when(n_parts > 0, F.sequence(F.lit(0), n_parts - 1))
    exploded = spans.select(*_cols(keep), ref(start), ref(end), n_parts.alias("n_parts"),
                            F.explode(parts).alias("part_no"))
    return exploded.select(
        *_cols(keep), start, end, "n_parts", "part_no",
        add_seconds(ref(start), F.col("part_no") * w).alias("part_start"),
        add_seconds(ref(start), (F.col("part_no") + 1) * w).alias("part_end"))


# --------------------------------------------------------------------------
# Adaptive refinement (WIN3, WIN4)
# --------------------------------------------------------------------------
def second_counts(df: DataFrame, ts: str, by: Sequence[str] = ()) -> DataFrame:
    """Records per second: ``n_exact`` on the second, ``n_frac`` after it."""
    sec = floor_to(ref(ts), 1)
    return (df.filter(ref(ts).isNotNull())
            .select(*_cols(by), ref(ts).alias("_ts"), sec.alias("sec"))
            .groupBy(*_cols(by), "sec")
            .agg(F.count_if(F.col("_ts") == F.col("sec")).alias("n_exact"),
                 F.count_if(F.col("_ts") != F.col("sec")).alias("n_frac")))


def _tail_cut(ladder: Sequence[int]) -> int:
    """Seconds into the day where a refined last slice stops covering (compat)."""
    w0, w1 = ladder[0], ladder[1]
    last_start = DAY - w0
    return last_start + ((w0 - 1) // w1) * w1


def _second_levels(df: DataFrame, ts: str, ladder: Sequence[int], cap: int,
                   by: Sequence[str], compat: bool, closed: bool = False) -> DataFrame:
    """Per (by, second): records ``n`` (after compat losses) and the chosen slice
    (``level_seconds``, ``slice_start``) of that second, plus ``p0``.

    With ``closed`` (N1) the records exactly on a second also get a row in the second
    before it, with that stamp as ``edge``: there they count for every slice that ends at
    the stamp, at any level, by sums over the same windows. Rows whose chosen slice does
    not end at their edge are left out.
    """
    ladder = [int(w) for w in ladder]
    if any(DAY % w for w in ladder) or any(a % b for a, b in zip(ladder, ladder[1:])):
        raise ValueError("ladder widths must divide a day and each other")
    sc = second_counts(df, ts, by)
    day = floor_to(F.col("sec"), DAY)
    off = seconds_between(day, F.col("sec"))
    parents = [floor_to(F.col("sec"), w).alias(f"p{i}") for i, w in enumerate(ladder)]
    n_all = F.col("n_exact") + F.col("n_frac")
    # N2: the closed day end 23:59:59 drops what follows it in the last second.
    n_eff = (F.col("n_exact") + F.when(off < DAY - 1, F.col("n_frac")).otherwise(F.lit(0))) \
        if compat else n_all
    no_edge = F.lit(None).cast("timestamp_ntz")
    base = sc.select(*_cols(by), "sec", off.alias("off"), n_eff.alias("n"), no_edge.alias("edge"))
    if closed:
        edges = sc.filter((F.col("n_exact") > 0) & (off > 0)).select(
            *_cols(by), add_seconds(F.col("sec"), -1).alias("sec"), (off - 1).alias("off"), F.col("n_exact").alias("n"),
            F.col("sec").alias("edge"))
        base = base.unionByName(edges)
    base = base.select("*", *parents)
    key0 = [*_cols(by), F.col("p0")]

    def in_slice(i: int) -> Column:
        """What a row counts for its slice of level i."""
        if not closed:
            return F.col("n")
        ends_here = F.col("edge").isNull() | (F.col("edge") == add_seconds(F.col(f"p{i}"), ladder[i]))
        return F.when(ends_here, F.col("n")).otherwise(F.lit(0))

    base = base.withColumn("c0", F.sum(in_slice(0)).over(Window.partitionBy(*key0)))
    if compat and len(ladder) > 1:
        # N3: a refined last slice is cut into int((w0 - 1) / w1) parts; the tail is lost.
        cut = _tail_cut(ladder)
        lost = (F.col("c0") >= cap) & (F.col("off") >= cut)
        base = base.withColumn("n", F.when(lost, F.lit(0)).otherwise(F.col("n")))
    for i in range(1, len(ladder)):
        key = key0 + [F.col(f"p{j}") for j in range(1, i + 1)]
        base = base.withColumn(f"c{i}", F.sum(in_slice(i)).over(Window.partitionBy(*key)))
    base = base.filter(F.col("n") > 0)
    level = F.lit(len(ladder) - 1)
    for i in reversed(range(len(ladder) - 1)):
        level = F.when(F.col(f"c{i}") < cap, F.lit(i)).otherwise(level)
    base = base.withColumn("lvl", level)
    width = F.element_at(F.array(*[F.lit(w) for w in ladder]), F.col("lvl") + 1)
    start = F.element_at(F.array(*[F.col(f"p{i}") for i in range(len(ladder))]), F.col("lvl") + 1)
    out = base.select(*_cols(by), "sec", "p0", width.alias("level_seconds"),
                      start.alias("slice_start"), "n", "edge")
    if not closed:
        return out.drop("edge")
    return out.filter(F.col("edge").isNull() | (F.col("edge") == add_seconds(F.col("slice_start"), F.col("level_seconds"))))


def adaptive_slices(df: DataFrame, ts: str, ladder: Sequence[int] = ORDER_LADDER,
                    cap: int = PAGE_SIZE, by: Sequence[str] = (), compat: bool = False,
                    cut_seconds: bool = False, page_size: int = PAGE_SIZE,
                    closed: bool = False) -> DataFrame:
    """Slices a day is fetched in, chosen by refinement (WIN3/WIN4, N1, N3-N5).

    A slice with ``n >= cap`` is refined to the next ladder width; 1-s slices are
    final. Columns: ``by..., level_seconds, slice_start, slice_end, n`` (records
    in the slice), ``n_captured`` (records the requests return: ``n`` unless
    ``compat`` and ``cut_seconds`` cut a 1-s slice to ``cap``) and ``n_pages``.
    ``closed`` counts ranges with both bounds, as the service is asked (``compat`` only).
    """
    if closed and not compat:
        raise ValueError("closed bounds are part of compat mode")
    ladder = [int(w) for w in ladder]
    chosen = _second_levels(df, ts, ladder, cap, by, compat, closed)
    out = (chosen.groupBy(*_cols(by), "p0", "level_seconds", "slice_start")
           .agg(F.sum("n").alias("n"))
           .select(*_cols(by), "level_seconds", "slice_start",
                   add_seconds(F.col("slice_start"), F.col("level_seconds")).alias("slice_end"),
                   "n"))
    is_second = F.col("level_seconds") == ladder[-1]
    captured = F.when(is_second & (F.col("n") > cap), F.lit(cap).cast("bigint")) \
        .otherwise(F.col("n")) if (compat and cut_seconds) else F.col("n")
    out = out.withColumn("n_captured", captured)
    pages = F.when(is_second, F.ceil(F.col("n_captured") / F.lit(page_size))).otherwise(F.lit(1))
    return out.withColumn("n_pages", pages.cast("bigint"))


def assign_slices(df: DataFrame, ts: str, ladder: Sequence[int] = ORDER_LADDER,
                  cap: int = PAGE_SIZE, by: Sequence[str] = (), sort: Sequence[str] = (),
                  page_size: int = PAGE_SIZE) -> DataFrame:
    """Every record with the slice whose request returns it and its page there
    (the slice loop of an extraction; WIN3/WIN4 + WIN6).

    Adds ``level_seconds, slice_start, slice_end, page_no``. Records are joined
    to their second's chosen slice on ``(by, second)``; only records of 1-s
    slices holding ``cap`` or more are numbered into pages, with the skew-safe
    :func:`row_numbers` (a hot second spreads over many tasks).
    """
    ladder = [int(w) for w in ladder]
    levels = _second_levels(df, ts, ladder, cap, by, compat=False).select(
        *_cols(by), F.col("sec").alias("_sec"), "level_seconds", "slice_start", "n")
    rows = df.withColumn("_sec", floor_to(ref(ts), 1))
    joined = rows.join(levels, on=[*by, "_sec"], how="inner")
    full = (F.col("level_seconds") == ladder[-1]) & (F.col("n") >= cap)
    order = [c for c in sort] or [ts]
    rest = joined.filter(~full).withColumn("page_no", F.lit(0).cast("bigint"))
    over = joined.filter(full)
    # Only over-full seconds are paged; when there is none (the usual case at
    # cap 200) the numbering jobs are skipped. The probe reads the per-second
    # table (one row per second), not the records.
    if levels.filter(full).isEmpty():
        out = rest
    else:
        out = assign_pages(over, [*by, "_sec"], order, page_size).drop("page_start") \
            .unionByName(rest)
    return out.withColumn("slice_end", add_seconds(F.col("slice_start"), F.col("level_seconds"))) \
        .drop("_sec", "n")


def compat_capture(df: DataFrame, ts: str, ladder: Sequence[int] = ORDER_LADDER,
                   cap: int = PAGE_SIZE, by: Sequence[str] = (),
                   sort: Sequence[str] = (), cut_seconds: bool = True) -> DataFrame:
    """Rows of ``df`` that the reference's requests would return for field ``ts``.

    Drops: stamps after 23:59:59 (N2); the tail of a refined last slice (N3);
    with ``cut_seconds``, all but the first ``cap`` rows (by ``sort``) of a second
    (N5). The per-day flag table has one row per (by, day); the cut is a
    ``row_number() <= cap`` filter, which Spark evaluates as a per-task group
    limit before the shuffle.
    """
    ladder = [int(w) for w in ladder]
    t = ref(ts)
    day = floor_to(t, DAY)
    rows = df.filter(t.isNotNull()).withColumn("_day", day)
    rows = rows.filter(t <= add_seconds(F.col("_day"), DAY - 1))
    if len(ladder) > 1:
        last_start = DAY - ladder[0]
        in_last = t >= add_seconds(F.col("_day"), last_start)
        last = (rows.filter(in_last).groupBy(*_cols(by), "_day")
                .agg(F.count(F.lit(1)).alias("_c0")))
        rows = rows.join(last, on=[*by, "_day"], how="left")
        lost = (F.coalesce(F.col("_c0"), F.lit(0)) >= cap) & \
            (t >= add_seconds(F.col("_day"), _tail_cut(ladder)))
        rows = rows.filter(~lost).drop("_c0")
    if cut_seconds:
        order = [ref(c) for c in sort] or [t]
        w = Window.partitionBy(*_cols(by), floor_to(t, 1)).orderBy(*order)
        rows = rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= cap) \
            .drop("_rn")
    return rows.drop("_day")


def closed_capture(df: DataFrame, ts: str, ladder: Sequence[int] = ORDER_LADDER,
                   cap: int = PAGE_SIZE, by: Sequence[str] = (), sort: Sequence[str] = (),
                   cut_seconds: bool = True) -> DataFrame:
    """Every record as often as the reference's requests return it (N1-N3, N5): once per
    request whose closed range holds it, so twice if it lies exactly on the boundary of two.

    Adds ``level_seconds, slice_start, slice_end``. Records meet the slices of their own
    second, and of the second before if they end at the record's stamp, in one equi-join on
    (by, second). ``cut_seconds`` keeps the first ``cap`` records (by ``sort``) of a 1-s request.
    """
    ladder = [int(w) for w in ladder]
    levels = _second_levels(df, ts, ladder, cap, by, compat=True, closed=True).select(
        *_cols(by), F.coalesce("edge", "sec").alias("_sec"), F.col("edge").isNotNull().alias("_edge"),
        "level_seconds", "slice_start")
    t = ref(ts)
    rows = df.filter(t <= add_seconds(floor_to(t, DAY), DAY - 1)).withColumn("_sec", floor_to(t, 1))
    out = rows.join(levels, on=[*by, "_sec"]).filter(~F.col("_edge") | (t == F.col("_sec")))
    out = out.drop("_sec", "_edge")
    if cut_seconds:
        second = F.col("level_seconds") == ladder[-1]
        cut = cap_per_group(out.filter(second), [*by, "slice_start"], list(sort) or [ts], cap)
        out = out.filter(~second).unionByName(cut)
    return out.withColumn("slice_end", add_seconds(F.col("slice_start"), F.col("level_seconds")))


# --------------------------------------------------------------------------
# Paging (WIN5, WIN6, WIN7, SRT3)
# --------------------------------------------------------------------------
PAGE_CHUNK = 4096


def page_offsets(df: DataFrame, n_col: str, page_size: int = PAGE_SIZE,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Offsets ``0, p, 2p, ...`` below ``n`` (WIN5); nothing for ``n = 0``.

    Columns: ``keep..., n_col, page_no, start``. Pages are generated in two
    bounded levels — chunks of ``PAGE_CHUNK`` pages, re-partitioned, then the
    pages of each chunk — so no array exceeds ``PAGE_CHUNK`` elements and a group
    with a huge count spreads its pages over many tasks.
    """
    p = int(page_size)
    n = ref(n_col)
    n_pages = F.ceil(n / F.lit(p)).cast("bigint")
    n_chunks = F.ceil(n_pages / F.lit(PAGE_CHUNK)).cast("bigint")
    chunks = F.when(n_pages > 0, F.sequence(F.lit(0).cast("bigint"), n_chunks - 1))
    rows = df.select(*_cols(keep), n, n_pages.alias("_pages"), F.explode(chunks).alias("_chunk"))
    rows = rows.repartition(*_cols(keep), F.col("_chunk"))
    first = F.col("_chunk") * PAGE_CHUNK
    last = F.least(first + PAGE_CHUNK, F.col("_pages")) - 1
    pages = rows.select(*_cols(keep), n, F.explode(F.sequence(first, last)).alias("page_no"))
    return pages.withColumn("start", (F.col("page_no") * p).cast("bigint"))


def row_numbers(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str],
                name: str = "rn", materialize: bool = True, tiebreak: bool = True) -> DataFrame:
    """``row_number() over (partition by ... order by ...)`` without gathering a
    partition group in one task.

    Rows are range-partitioned on (partition, order) keys and sorted, so a hot
    group spreads over many tasks. Each task numbers its rows per group; a group
    that began in earlier tasks continues from their counts. Only the first group
    of a task can continue, so the carry table has one row per task: its size is
    the number of tasks, which makes it safe to broadcast.

    ``materialize`` checkpoints the range-partitioned rows to the shared
    checkpoint folder, so both uses see the same task boundaries and a lost
    executor does not re-draw them. ``tiebreak`` appends a row id taken before
    the exchange to the sort keys, so identical copies of one key are still
    split across tasks (their relative numbering is then arbitrary, as among
    equal rows of any ``row_number``).
    """
    part, order = list(partition_cols), list(order_cols)
    if tiebreak:
        df = df.withColumn("_tb", F.monotonically_increasing_id())
        order = order + ["_tb"]
    keys = part + order
    ranged = (df.repartitionByRange(*_cols(keys)).sortWithinPartitions(*_cols(keys))
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_g", F.struct(*_cols(part)) if part else F.lit(0)))
    if materialize:
        ensure_checkpoint_dir(df.sparkSession)
        ranged = ranged.checkpoint(eager=True)
    # Rows per (task, group): at most groups + tasks rows, aggregated map-side.
    per = ranged.groupBy("_pid", "_g").agg(F.count(F.lit(1)).alias("_n"))
    tasks = per.groupBy("_pid").agg(F.min("_g").alias("_first"), F.max("_g").alias("_last"),
                                    F.max_by("_n", "_g").alias("_n_last"),
                                    F.count(F.lit(1)).alias("_groups"))
    # One row per task, so these windows over all tasks are small.
    by_task = Window.orderBy("_pid")
    running = by_task.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cont = F.coalesce(F.lag("_last").over(by_task) == F.col("_first"), F.lit(False))
    tasks = tasks.withColumn("_cont", cont)
    # A chain of tasks holding one continuing group is summed; a chain restarts at
    # a task that starts a new group or holds several groups.
    head = (~(F.col("_cont") & (F.col("_groups") == 1))).cast("int")
    tasks = tasks.withColumn("_seg", F.sum(head).over(running))
    tasks = tasks.withColumn("_run", F.sum("_n_last").over(
        Window.partitionBy("_seg").orderBy("_pid").rowsBetween(Window.unboundedPreceding,
                                                                Window.currentRow)))
    carry = tasks.select("_pid", "_first", F.when(
        F.col("_cont"), F.lag("_run").over(by_task)).otherwise(F.lit(0)).alias("_carry"))
    w = Window.partitionBy("_pid", "_g").orderBy(*_cols(keys))
    local = ranged.withColumn("_rl", F.row_number().over(w))
    out = local.join(F.broadcast(carry), on="_pid", how="left")
    rn = F.col("_rl") + F.when(F.col("_g") == F.col("_first"), F.col("_carry")).otherwise(F.lit(0))
    return out.withColumn(name, rn.cast("bigint")).drop("_pid", "_g", "_rl", "_first", "_carry",
                                                         "_tb")


def assign_pages(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str],
                 page_size: int = PAGE_SIZE) -> DataFrame:
    """Page number ``(row_number - 1) div page_size`` within each partition (WIN6)."""
    numbered = row_numbers(df, partition_cols, order_cols, "_rn")
    return (numbered.withColumn("page_no", F.floor((F.col("_rn") - 1) / F.lit(int(page_size)))
                                .cast("bigint"))
            .withColumn("page_start", ((F.col("page_no")) * int(page_size)).cast("bigint"))
            .drop("_rn"))


def cap_per_group(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str],
                  cap: int = PAGE_SIZE) -> DataFrame:
    """First ``cap`` rows of each group (WIN7, SRT3): ``row_number() <= cap``.

    Spark plans this as a per-task group limit before the exchange, so at most
    ``cap`` rows per group and task are shuffled, whatever the group's size.
    """
    w = Window.partitionBy(*_cols(partition_cols)).orderBy(*_cols(order_cols))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= int(cap)) \
        .drop("_rn")


__all__ = ["fixed_slices", "slice_grid", "sub_slices", "second_counts", "adaptive_slices",
           "assign_slices", "compat_capture", "closed_capture", "page_offsets", "row_numbers", "assign_pages",
           "cap_per_group"]
