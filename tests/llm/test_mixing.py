"""Schedules and the placing of rows."""

from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartloom.llm import mixing
from cartloom.llm.mixing import mix, period, phases, slot


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=12))
def test_period_deviates_less_than_one_block(parts):
    parts = {f"s{i}": a for i, a in enumerate(parts)}
    q, got = sum(parts.values()), Counter()
    slots = period(parts)
    for t, s in enumerate(slots, 1):
        got[s] += 1
        for x, a in parts.items():
            assert abs(got[x] - Fraction(a * t, q)) < 1
    assert got == parts


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.sampled_from(["a", "b", "c", "d", None]), st.tuples(st.integers(1, 30), st.integers(1, 9)),
                       min_size=1))
def test_phases_fill_all_slots_and_keep_shares(sources):
    blocks, parts = {s: n for s, (n, _) in sources.items()}, {s: a for s, (_, a) in sources.items()}
    plan, at = phases(blocks, parts), {}
    for s, n in blocks.items():
        for k in range(n):
            at[slot([p for p in plan[s] if p["first"] <= k][-1], k)] = s
    assert sorted(at) == list(range(sum(blocks.values())))
    # Slot by slot: among the sources with blocks left, shares since the last one ran out.
    left, got, t = dict(blocks), Counter(), 0
    for i in range(len(at)):
        live = {s: parts[s] for s, n in left.items() if n}
        got[at[i]] += 1
        left[at[i]] -= 1
        t += 1
        for s, a in live.items():
            assert abs(got[s] - Fraction(a * t, sum(live.values()))) < 1
        if not left[at[i]]:
            got, t = Counter(), 0


def test_rows_are_placed_once(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", 10)
    rows = [(i, f"t{i}", "big" if i % 3 else None) for i in range(200)] + [(1000 + i, None, "small") for i in range(21)]
    rows += [(None, "x", "big"), (None, None, "big"), (7, "t7", None), (7, "t7", None)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, source string, _k int")
    got = mix(df, {"big": 3, None: 2, "small": 1}, block=4).collect()
    assert sorted(((r["doc_id"], r["text"], r["source"]) for r in got), key=str) == sorted(rows, key=str)
    assert sorted(r["mix_position"] for r in got) == list(range(len(rows)))
    assert {r["_k"] for r in got} == {5}
    by_slot = {}
    for r in sorted(got, key=lambda r: r["mix_position"]):
        by_slot.setdefault(r["mix_slot"], []).append(r["source"])
    assert list(by_slot) == list(range(len(by_slot))) and all(len(set(x)) == 1 for x in by_slot.values())
    assert max(map(len, by_slot.values())) == 4
    counts = Counter()
    for t, sources in by_slot.items():  # until the first source runs out
        counts[sources[0]] += 1
        assert all(abs(counts[s] - a * (t + 1) / 6) < 1 for s, a in (("big", 3), (None, 2), ("small", 1)))
        if counts["small"] == 6:
            break


def test_no_rows_and_bounds(spark, monkeypatch):
    assert mix(spark.createDataFrame([], "doc_id long, source string")).collect() == []
    monkeypatch.setattr(mixing, "MAX_SOURCES", 1)
    with pytest.raises(ValueError):
        mix(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, source string"))


def test_more_sources_than_one_schedule_holds(spark):
    """With the production setting: every row is placed once, in blocks, without gaps."""
    rows = [(10_000 * s + i, f"host{s}") for s in range(700) for i in range(1 + s % 41)]
    rows += [(9_000_000 + i, None) for i in range(333)]
    got = mix(spark.createDataFrame(rows, "doc_id long, source string")).collect()
    assert sorted(((r["doc_id"], r["source"]) for r in got), key=str) == sorted(rows, key=str)
    assert sorted(r["mix_position"] for r in got) == list(range(len(rows)))
    by_slot = {}
    for r in sorted(got, key=lambda r: r["mix_position"]):
        by_slot.setdefault(r["mix_slot"], []).append(r["source"])
    assert list(by_slot) == list(range(len(by_slot))) and all(len(set(x)) == 1 for x in by_slot.values())
    assert max(map(len, by_slot.values())) == mixing.BLOCK


def test_levels_keep_shares_on_every_level(monkeypatch):
    monkeypatch.setattr(mixing, "FAN", 3)
    blocks, parts = {f"s{i}": 40 * (1 + i % 3) for i in range(20)}, {f"s{i}": 1 + i % 3 for i in range(20)}
    plans = mixing.levels(blocks, parts)
    assert len(plans) == 3
    at = {mixing.placed(plans, s, k): s for s, n in blocks.items() for k in range(n)}
    assert sorted(at) == list(range(sum(blocks.values())))
    got = Counter()
    for t in range(len(at)):
        got[at[t]] += 1
        assert all(abs(got[s] - Fraction(a * (t + 1), sum(parts.values()))) < len(plans) for s, a in parts.items())
