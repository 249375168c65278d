"""Mixing sources to target weights by Pfair scheduling.

Every source is cut into blocks of ``block`` rows (in hash order of the rows). A source with
``a`` of ``q`` parts has weight w = a / q; its k-th block (from 1) may be placed from slot
floor((k - 1) / w) on and must be placed before slot ceil(k / w). Slots are filled earliest
deadline first among the released blocks, so after any number of slots every source has
received within less than one block of its share. Weights are integer parts, so the schedule
repeats after q slots: one period is scheduled, and the slot of any block follows from it.

When a source runs out the other sources share the following slots by their own parts: the
schedule goes on in a new phase, and the bound holds within every phase. All rows are placed
exactly once; only the last block of a source may be short.

More than ``FAN`` sources are scheduled in exact levels: those that run out at about the same
time form groups of at most ``FAN`` with the sum of their blocks and parts, groups form groups
in turn, and every level's slots are the blocks of its group. All rows are placed exactly once
as before; the bound of one block then holds on every level for a source within its group.

Scale: the driver holds one count per source and one period per phase and group, cut to the
slots that the phase uses. All work on rows is a partial count, a two-level numbering by hash
ranges (so a source with a third of all rows is spread over many tasks) and a join with the
schedule of every level.

Edge cases: null sources form one source of their own; a null or repeated id is placed like
any other row (equal rows are told apart by their place within a task's order, which cannot
be seen in the result); sources that have no target get ``1`` part; an empty table gives an
empty result. Extra columns are kept by ``mix`` and may have any name but those of its two results.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartloom.llm.common import table

BLOCK = 16
#: Rows that one numbering group should hold at most, on average.
GROUP_ROWS = 20_000
#: Sources that one schedule places at once; more are scheduled in levels.
FAN = 256
#: A caller may bound the number of sources; more then raise an error.
MAX_SOURCES = math.inf
#: Largest sum of target parts that a caller may give.
MAX_PARTS = 20_000


def default_parts(counts: dict[str | None, int]) -> dict[str | None, int]:
    """Target parts from sizes: proportional to the square root of a source's rows, so that
    large sources weigh more than small ones but less than by size."""
    total = sum(counts.values()) or 1
    return {s: max(1, round(100 * math.sqrt(n / total))) for s, n in counts.items()}


def period(parts: dict) -> list:
    """The sources of one period's slots, earliest deadline first among the released."""
    q = sum(parts.values())
    order = {s: i for i, s in enumerate(sorted(parts, key=lambda s: (s is not None, s)))}
    # Releases by slot: block k of a source with a parts is released at floor((k - 1) q / a).
    released: dict[int, list] = {}
    for s, a in parts.items():
        for k in range(a):
            released.setdefault(k * q // a, []).append((-(-(k + 1) * q // a), order[s], s))
    ready: list = []
    slots = []
    for t in range(q):
        for item in released.get(t, ()):
            heapq.heappush(ready, item)
        slots.append(heapq.heappop(ready)[2])
    return slots


def phases(blocks: dict, parts: dict) -> dict[str | None, list[dict]]:
    """Per source its phases: first block, first slot, period length q, parts a and the slots
    of its a blocks within the period (of a phase that ends before, those it reaches)."""
    plan: dict = {s: [] for s in blocks}
    left, done, at = dict(blocks), dict.fromkeys(blocks, 0), 0
    while left := {s: n for s, n in left.items() if n > 0}:
        step = math.gcd(*(parts[s] for s in left))
        now = {s: parts[s] // step for s in left}
        slots = period(now)
        q = len(slots)
        places: dict = {s: [] for s in now}
        for t, s in enumerate(slots):
            places[s].append(t)
        # The phase ends with the slot of the first source that runs out.
        end = 1 + min((left[s] - 1) // a * q + places[s][(left[s] - 1) % a] for s, a in now.items())
        full, rest = divmod(end, q)
        for s, a in now.items():
            last = sum(t < rest for t in places[s])
            plan[s].append({"first": done[s], "at": at, "q": q, "a": a,
                            "places": places[s] if full else places[s][:last]})
            taken = full * a + last
            done[s] += taken
            left[s] -= taken
        at += end
    return plan


def slot(phase: dict, k: int) -> int:
    """Slot of block ``k`` (from 0) of a source in one of its phases."""
    j = k - phase["first"]
    return phase["at"] + j // phase["a"] * phase["q"] + phase["places"][j % phase["a"]]


def levels(blocks: dict, parts: dict) -> list[tuple[dict, dict]]:
    """Per level (plan by member, group by member), from the sources up; members of the last
    level have no group. Groups are numbers."""
    out = []
    while len(blocks) > FAN:
        # Members that run out together keep the shares of the others longest.
        order = sorted(blocks, key=lambda s: (blocks[s] / parts[s], s is not None, s))
        n = -(-len(order) // FAN)
        groups = [order[g * len(order) // n:(g + 1) * len(order) // n] for g in range(n)]
        plan: dict = {}
        for members in groups:
            plan |= phases({s: blocks[s] for s in members}, {s: parts[s] for s in members})
        out.append((plan, {s: g for g, members in enumerate(groups) for s in members}))
        blocks, parts = ({g: sum(x[s] for s in members) for g, members in enumerate(groups)} for x in (blocks, parts))
    return [*out, (phases(blocks, parts), {})]


def placed(plans: list[tuple[dict, dict]], s: str | None, k: int) -> int:
    """Slot of block ``k`` (from 0) of a source over all levels."""
    for plan, group in plans:
        k = slot([p for p in plan[s] if p["first"] <= k][-1], k)
        s = group.get(s)
    return k


PHASES = "array<struct<first: long, at: long, q: long, a: long, places: array<long>>>"


def _slots(rows: DataFrame) -> DataFrame:
    """``rows`` with their block ``_k`` replaced by its slot in the schedule ``_plan``."""
    phase = F.element_at(F.filter("_plan", lambda p: p["first"] <= F.col("_k")), -1)
    rows = rows.withColumn("_p", phase).withColumn("_j", F.col("_k") - F.col("_p.first"))
    place = F.get(F.col("_p.places"), (F.col("_j") % F.col("_p.a")).cast("int"))
    whole = F.floor(F.col("_j") / F.col("_p.a")).cast("long")
    return rows.withColumn("_k", F.col("_p.at") + whole * F.col("_p.q") + place).drop("_p", "_j", "_plan")


def _missing(spark, rows: DataFrame, gaps: list[tuple[int, int]]) -> DataFrame:
    """``rows`` with ``_missing``: rows that short blocks of slots before theirs lack."""
    zero, parts, total = F.lit(0).cast("long"), [], 0
    for at in range(0, len(gaps), FAN):
        part = gaps[at:at + FAN]
        parts.append((part[0][0], total, part))
        total += sum(n for _, n in part)
    if not parts:
        return rows.withColumn("_missing", zero)
    # One row: pieces of up to FAN gaps, each with what lacks before it.
    held = spark.createDataFrame([(parts,)], "_gaps array<struct<t: long, n: long, of: array<struct<t: long, n: long>>>>")
    piece = F.element_at(F.filter("_gaps", lambda g: g["t"] < F.col("mix_slot")), -1)
    try_piece = F.when(F.element_at("_gaps", 1)["t"] < F.col("mix_slot"), piece)
    within = F.aggregate(F.col("_g.of"), zero, lambda acc, g: acc + F.when(g["t"] < F.col("mix_slot"), g["n"]).otherwise(zero))
    return (rows.crossJoin(F.broadcast(held)).withColumn("_g", try_piece)
            .withColumn("_missing", F.coalesce(F.col("_g.n") + within, zero)).drop("_gaps", "_g"))


def mix(docs: DataFrame, parts: dict | None = None, id_col: str = "doc_id",
        source_col: str = "source", block: int = BLOCK) -> DataFrame:
    """``docs`` with ``mix_slot`` (the slot of the row's block) and ``mix_position`` (the row's
    place in the whole order, from 0 and without gaps)."""
    spark, names = docs.sparkSession, docs.columns
    counted = docs.groupBy(F.col(f"`{source_col}`").cast("string").alias("s")).count().collect()
    counts = {r["s"]: r["count"] for r in counted}
    if len(counts) > MAX_SOURCES or sum((parts or {}).values()) > MAX_PARTS:
        raise ValueError(f"more than {MAX_SOURCES} sources or {MAX_PARTS} parts")
    chosen = default_parts(counts) if parts is None else {s: parts.get(s, 1) for s in counts}
    blocks = {s: -(-n // block) for s, n in counts.items()}
    plans = levels(blocks, chosen)
    # Short last blocks leave gaps in slot * block: rows that are missing before a slot.
    gaps = sorted((placed(plans, s, blocks[s] - 1), blocks[s] * block - n) for s, n in counts.items())
    gaps = [(t, n) for t, n in gaps if n]
    (plan, group), *upper = plans
    planned = spark.createDataFrame(
        [(s is None, s or "", group.get(s), phase) for s, phase in plan.items()],
        f"_null boolean, _s string, _group long, _plan {PHASES}")
    # Small for a few sources; else Spark chooses the join.
    planned = planned if upper else F.broadcast(planned)
    spread = math.ceil(math.log2(max(1.0, max(counts.values(), default=1) / GROUP_ROWS)))
    # Numbering in two levels: hash ranges of a source, then rows within a range.
    ids = [F.col(f"`{c}`") for c in dict.fromkeys((id_col, "text")) if c in names]
    digest = F.when(ids[0].isNull(), F.xxhash64(*ids)).otherwise(F.xxhash64(ids[0]))
    source = F.col(f"`{source_col}`").cast("string")
    # The input's columns travel as one struct, so their names cannot clash with the added ones.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), digest.alias("_h"),
                       source.isNull().alias("_null"), F.coalesce(source, F.lit("")).alias("_s"))
    ids = [F.col(f"_row.`{c}`") for c in dict.fromkeys((id_col, "text")) if c in names]
    rows = rows.withColumn("_b", F.shiftrightunsigned("_h", 64 - spread) if spread
                           else F.lit(0).cast("long"))
    key = ["_null", "_s", "_b"]
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    before = (Window.partitionBy("_null", "_s").orderBy("_b")
              .rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(*key, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*key).orderBy("_h", *ids)
    ranked = (rows.withColumn("_r", F.row_number().over(within) - 1).join(sizes, key)
              .withColumn("_rank", F.col("_before") + F.col("_r"))
              .withColumn("_k", F.floor(F.col("_rank") / block).cast("long"))
              .join(planned, ["_null", "_s"]))
    ranked = _slots(ranked)
    for plan, group in upper:
        # One row per FAN members of the level below.
        table_ = spark.createDataFrame([(g, group.get(g), phase) for g, phase in plan.items()],
                                       f"_group long, _up long, _plan {PHASES}")
        ranked = _slots(ranked.join(table_, "_group")).drop("_group").withColumnRenamed("_up", "_group")
    ranked = _missing(spark, ranked.withColumn("mix_slot", F.col("_k")), gaps)
    position = F.col("mix_slot") * block + F.col("_rank") % block - F.col("_missing")
    return ranked.withColumn("mix_position", position).select(
        *[F.col(f"_row.`{c}`") for c in names], "mix_slot", "mix_position")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place every document: ``doc_id, source, mix_slot, mix_position``."""
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source"))
