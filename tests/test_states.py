"""States kept from day to day (masks, bitmaps, closures) against the plain computation."""

import datetime as dt
import random

import pytest
from helpers import as_set, edges, event, membership, workspace

from tallyboard.operators.bitmaps import daily_bitmaps, number_members, sliding_distinct
from tallyboard.operators.closure import ancestors, maintain
from tallyboard.operators.masks import MASK_DAYS, advance, days_active
from tallyboard.operators.periods import Span, earlier_values
from tallyboard.plans import enterprise, org, reach
from tallyboard.plans.jobs import MASK_STATE, Backfill
from tallyboard.sources.store import Store

FIRST = dt.date(2024, 1, 1)


def day(n):
    return FIRST + dt.timedelta(n)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def visits():
    r = random.Random(11)
    return [(day(r.randrange(45)), str(r.randrange(40))) for _ in range(400)]


def seen(spark, rows):
    return spark.createDataFrame(rows, "ldate date, user_id string")


# --- masks ----------------------------------------------------------------------------
@pytest.mark.parametrize("gap", [1, 8, 29, 30, 31, 44])
def test_masks_over_a_gap_equal_masks_from_scratch(spark, visits, gap):
    df, last = seen(spark, visits), day(44)
    earlier = advance(df, ["user_id"], last - dt.timedelta(gap))
    stepped = advance(df, ["user_id"], last, earlier, last - dt.timedelta(gap))
    assert as_set(stepped, "ldate", "user_id", "mask") == as_set(advance(df, ["user_id"], last), "ldate", "user_id", "mask")


def test_mask_days_equal_distinct_days(spark, visits):
    masks = advance(seen(spark, visits), ["user_id"], day(40))
    for days in (1, 7, MASK_DAYS):
        want = {}
        for d, u in set(visits):
            if 0 <= (day(40) - d).days < days:
                want[u] = want.get(u, 0) + 1
        assert as_set(masks.select("user_id", days_active(days).alias("n")).filter("n > 0"), "user_id", "n") == set(want.items())


def test_mask_edges(spark):
    rows = [(day(5), None), (None, "a"), (day(9), "late"), (day(5), "x"), (day(5), "x")]
    assert as_set(advance(seen(spark, rows), ["user_id"], day(6)), "user_id", "mask") == {(None, 2), ("x", 2)}
    assert advance(seen(spark, []), ["user_id"], day(6)).count() == 0
    with pytest.raises(ValueError):
        advance(seen(spark, rows), ["user_id"], day(6), seen(spark, rows), day(6))
    with pytest.raises(ValueError):
        days_active(MASK_DAYS + 1)


def test_masks_are_hashed_with_a_partial_step(spark, visits, tmp_path):
    seen(spark, visits).write.parquet(f"{tmp_path}/v")
    text = plan(advance(spark.read.parquet(f"{tmp_path}/v"), ["user_id"], day(40)))
    assert "partial_bit_or" in text and "SortAggregate" not in text and text.count("Exchange hash") == 1


def test_backfill_with_masks_equals_plain_one_over_gaps_and_late_rows(spark, tmp_path):
    r = random.Random(3)
    rows = [event(user=str(r.randrange(1, 12)), day=day(r.randrange(40))) for _ in range(150)]
    people = [(n, n % 3, 1) for n in range(1, 12)]
    late = rows + [event(user="5", day=day(21)), event(user="6", day=day(24))]

    def base(rows):
        return workspace(spark, rows, people, membership=membership(spark, [(n, 2, 10) for n in range(3)]))

    out = {}
    for name, carry in (("plain", False), ("masks", True)):
        store = Store(spark, f"{tmp_path}/{name}")
        for events, span in ((rows, (day(20), day(22))), (rows, (day(26),)), (late, (day(27), day(28)))):
            Backfill(base(events), store, carry_masks=carry).run(*span, tasks=[enterprise.USERS_TABLE])
        out[name] = as_set(store.read(enterprise.USERS_TABLE), "ldate", "team_id", "active_uv", "deep_active_uv", "before_7d_active_uv")
        assert bool(store.days(MASK_STATE)) == carry
    assert out["masks"] == out["plain"] and len(out["masks"]) > 10


# --- bitmaps --------------------------------------------------------------------------
def distinct_by_hand(visits, team_of, span, days):
    out = {}
    for d in span.dates():
        for u, t in team_of.items():
            if any(v == u and 0 <= (d - l).days < days for l, v in visits):
                out[d, t] = out.get((d, t), 0) + 1
    return {(d, t, n) for (d, t), n in out.items()}


@pytest.mark.parametrize("days", [1, 7, 30])
def test_sliding_distinct_equals_count_distinct(spark, visits, days):
    team_of = {str(u): u % 4 for u in range(40)}
    numbers = number_members(spark.createDataFrame(list(team_of.items()), "user_id string, team_id long"), "team_id", "user_id")
    maps = daily_bitmaps(seen(spark, visits), numbers, "team_id", "user_id")
    span = Span.of(day(5), day(60))  # ends after the last visit
    assert as_set(sliding_distinct(maps, "team_id", span, days, "uv"), "ldate", "team_id", "uv") == distinct_by_hand(visits, team_of, span, days)


def test_bitmaps_of_several_buckets_and_small_groups(spark):
    people = spark.range(70_000).selectExpr("CAST(id AS STRING) AS user_id", "CASE WHEN id < 69990 THEN 1L ELSE 2L END AS team_id")
    numbers = number_members(people, "team_id", "user_id")
    rows = people.selectExpr("DATE '2024-01-03' AS ldate", "user_id")
    maps = daily_bitmaps(rows, numbers, "team_id", "user_id")
    assert as_set(maps.selectExpr("team_id", "count(*) OVER (PARTITION BY team_id) AS n"), "team_id", "n") == {(1, 3), (2, 1)}
    assert maps.filter("team_id = 2").selectExpr("length(bitmap) AS n").first().n == 2
    assert as_set(sliding_distinct(maps, "team_id", Span.of("2024-01-05"), 7, "uv"), "team_id", "uv") == {(1, 69_990), (2, 10)}


def test_numbers_are_kept_and_stay_dense(spark):
    first = number_members(spark.createDataFrame([("a", 1), ("c", 1), ("x", 2), (None, 1)], "user_id string, team_id int"), "team_id", "user_id")
    then = number_members(spark.createDataFrame([("a", 1), ("b", 1), ("n", 3)], "user_id string, team_id int"), "team_id", "user_id", first)
    assert as_set(then, "team_id", "user_id", "number") == {(1, "a", 1), (1, "c", 2), (2, "x", 1), (1, "b", 3), (3, "n", 1)}


def test_stored_bitmaps_follow_users_who_change_team(spark, tmp_path):
    r = random.Random(8)
    rows = [event(user=str(r.randrange(1, 10)), day=day(r.randrange(35))) for _ in range(120)]
    visits = [(e[0], e[3]) for e in rows]
    store = Store(spark, str(tmp_path))
    for people, span in (({n: n % 2 for n in range(1, 9)}, Span.of(day(29), day(31))),
                         ({**{n: n % 2 for n in range(1, 9)}, 4: 1, 9: 0, 2: None}, Span.of(day(32))),
                         ({**{n: n % 2 for n in range(1, 9)}, 9: 0}, Span.of(day(33), day(34)))):
        ws = workspace(spark, rows, [(n, t, 1) for n, t in people.items()])
        reach.refresh_bitmaps(store, ws, span)
        team_of = {str(n): t for n, t in people.items() if t is not None}
        for days in (7, 30):
            assert as_set(reach.active_users(store, span, days), "ldate", "team_id", "active_uv") == distinct_by_hand(visits, team_of, span, days)
    assert reach.refresh_bitmaps(store, ws, span) == []  # nothing changed, nothing is made again


# --- closures --------------------------------------------------------------------------
def graph(spark, pairs):
    return spark.createDataFrame(sorted(pairs), "node int, parent int")


def nodes(spark, ids):
    return spark.createDataFrame([(i,) for i in sorted(ids)], "node int")


@pytest.mark.parametrize("seed", range(4))
def test_maintained_closure_equals_rebuild(spark, seed):
    """Random edges both ways, so with cycles; random inserts, removes and seeds."""
    r = random.Random(seed)
    old = {(r.randrange(14), r.randrange(14)) for _ in range(18)}
    new = {e for e in old if r.random() > 0.25} | {(r.randrange(14), r.randrange(14)) for _ in range(4)}
    seeds_old, seeds_new = set(range(0, 9)), set(range(2, 12))
    before = ancestors(nodes(spark, seeds_old), graph(spark, old))
    change = maintain(before, nodes(spark, seeds_new), graph(spark, old), graph(spark, new))
    a, b = as_set(before, "seed", "anc"), as_set(ancestors(nodes(spark, seeds_new), graph(spark, new)), "seed", "anc")
    rows = [tuple(x) for x in change.pairs.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == b
    assert as_set(change.removed, "seed", "anc") == a - b and as_set(change.added, "seed", "anc") == b - a


def test_removed_edge_of_a_cycle_and_another_way_up(spark):
    old = {(1, 2), (2, 3), (3, 2), (3, 4), (1, 5), (5, 4)}
    new = old - {(3, 4), (1, 2)}
    before = ancestors(nodes(spark, [1, 2]), graph(spark, old))
    change = maintain(before, nodes(spark, [1, 2]), graph(spark, old), graph(spark, new))
    assert as_set(change.pairs, "seed", "anc") == {(1, 1), (1, 5), (1, 4), (2, 2), (2, 3)}
    assert as_set(change.removed, "seed", "anc") == {(1, 2), (1, 3), (2, 4)} and change.added.count() == 0


def test_no_change_is_no_change(spark):
    e = {(1, 2), (2, 3)}
    change = maintain(ancestors(nodes(spark, [1]), graph(spark, e)), nodes(spark, [1]), graph(spark, e), graph(spark, e))
    assert change.removed.count() == change.added.count() == 0 and change.pairs.count() == 3


def test_updated_bridge_equals_rebuild(spark):
    r = random.Random(4)

    def draw():
        users = {((11, u), (10, r.randrange(8))) for u in range(30)}
        return users | {((10, d), (10, r.randrange(10))) for d in range(10)} | {((10, 0), (9, 1)), ((10, 3), (9, 2))}

    old = draw()
    new = {e for e in old if r.random() > 0.15} | set(r.sample(sorted(draw()), 6))
    a, b = edges(spark, sorted(old)), edges(spark, sorted(new))
    bridge, closure = org.update_user_departments(org.user_departments(a), org.bridge_closure(a), a, b)
    rows = [tuple(x) for x in bridge.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == as_set(org.user_departments(b), "user_id", "department_id")
    assert as_set(closure, "seed", "anc") == as_set(org.bridge_closure(b), "seed", "anc")


# --- period over period -------------------------------------------------------------------
def test_earlier_values_skip_missing_days_in_one_shuffle(spark, tmp_path):
    rows = [(day(0), 1, 5), (day(7), 1, 6), (day(8), 1, 7), (day(14), 1, None), (day(21), 1, 9), (day(7), 2, 1), (None, 1, 3)]
    spark.createDataFrame(rows, "ldate date, k int, v long").write.parquet(f"{tmp_path}/d")
    out = earlier_values(spark.read.parquet(f"{tmp_path}/d"), ["k"], ["v"], 7, "before_")
    assert as_set(out, "ldate", "k", "before_v") == {
        (day(0), 1, None), (day(7), 1, 5), (day(8), 1, None), (day(14), 1, 6), (day(21), 1, None), (day(7), 2, None), (None, 1, None)}
    assert plan(out).count("Exchange hash") == 1
