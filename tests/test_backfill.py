"""Properties that tie the jobs together."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from tallyboard.operators.periods import Span
from tallyboard.plans import enterprise, jobs, rankings, usage
from tallyboard.sources.store import Store

START, END = "2024-01-14", "2024-01-15"


@pytest.fixture(scope="module")
def ws(spark, sf_dir):
    full = fx.workspace(spark, sf_dir, "membership", "departments", "files")
    return full.with_(user_dep=fx.user_dep(spark, sf_dir).persist())


@pytest.fixture(scope="module")
def stores(spark, ws, tmp_path_factory):
    made = {}
    for bulk in (True, False):
        store = Store(spark, str(tmp_path_factory.mktemp("store")))
        jobs.Backfill(ws, store, bulk=bulk).run(START, END)
        made[bulk] = store
    return made


def rows(df):
    cols = sorted(df.columns)
    return sorted(map(str, (tuple(r) for r in df.select(*cols).collect())))


@pytest.mark.parametrize("table", list(jobs.JOBS))
def test_bulk_equals_day_by_day(stores, table):
    bulk, daily = rows(stores[True].read(table)), rows(stores[False].read(table))
    assert bulk == daily and bulk


DIRECT = [t for t in jobs.JOBS if t not in (enterprise.USERS_TABLE, enterprise.TOTALS_TABLE, enterprise.CREATION_TABLE)]


@pytest.mark.parametrize("table", DIRECT)
def test_rollups_give_what_raw_events_give(ws, stores, table):
    direct = jobs.JOBS[table](ws, Span.of(END))
    assert rows(stores[True].read_day(table, END)) == rows(direct)


@pytest.mark.parametrize("table", DIRECT)
def test_bulk_from_raw_events(ws, stores, table):
    assert rows(jobs.JOBS[table](ws, Span.of(START, END))) == rows(stores[True].read(table))


def test_long_bulk_with_seven_day_look_back(ws):
    """Nine dates at once: the look-back of the last two falls inside the span."""
    span = Span.of("2024-01-08", "2024-01-16")
    bulk = enterprise.seats_and_activity(ws, span)
    first = enterprise.seats_and_activity(ws, Span.of("2024-01-08"))
    alone = enterprise.seats_and_activity(ws.with_(snapshot=lambda t: first), Span.of("2024-01-15"))
    assert rows(bulk.filter("ldate = date'2024-01-15'")) == rows(alone)


def test_totals_fold_equals_one_sum(ws):
    store = enterprise.usage_to_date(ws, Span.of("2024-01-01"))
    for d in range(2, 6):
        stored = store
        store = enterprise.usage_to_date(ws.with_(snapshot=lambda t, s=stored: s), Span.of(dt.date(2024, 1, d)))
    bulk = enterprise.usage_to_date(ws, Span.of("2024-01-01", "2024-01-05")).filter("ldate = date'2024-01-05'")
    assert rows(store) == rows(bulk)


def test_members_add_up_to_their_team(ws):
    team = usage.usage(ws, usage.FILE_BY_TEAM, Span.of(END))
    members = (usage.usage(ws, usage.FILE_BY_MEMBER, Span.of(END)).groupBy("ldate", "team_id")
               .agg(*[F.sum(c).alias(c) for c in ("create_files", "import_files", "upload_files")]))
    active = team.filter("create_files + import_files + upload_files > 0")
    assert set(rows(active)) <= set(rows(members))
    assert members.join(team, "team_id", "left_anti").count() == 0


def test_products_stay_within_all_objects(ws):
    df = usage.usage(ws, usage.PRODUCT_BY_MEMBER, Span.of(END))
    parts = " + ".join(f"create_{n}" for n in usage.PRODUCTS)
    assert df.filter(f"{parts} > create_objs").count() == 0


def test_rerun_changes_nothing(spark, ws, stores):
    store = stores[False]
    before = {t: rows(store.read(t)) for t in ("file_7d_statistic_by_global", enterprise.TOTALS_TABLE)}
    jobs.Backfill(ws, store, bulk=False).run(END, END, list(before))
    assert {t: rows(store.read(t)) for t in before} == before


def test_unknown_task_is_refused(ws, stores):
    with pytest.raises(KeyError):
        jobs.Backfill(ws, stores[True]).run(START, END, ["no_such_table"])


def test_dimensions_are_stored(spark, sf_dir, tmp_path):
    store = Store(spark, str(tmp_path))
    deps, files = jobs.refresh_dimensions(store, fx.edges(spark, sf_dir), fx.file_source(spark, sf_dir, 2),
                                          fx.file_source(spark, sf_dir, 3))
    assert rows(deps) == rows(fx.user_dep(spark, sf_dir)) and files.count() == fx.files(spark, sf_dir).count()


@pytest.mark.parametrize("bulk", [True, False])
def test_carried_space_state_gives_the_same_list(spark, ws, stores, tmp_path, bulk):
    store = Store(spark, str(tmp_path))
    run = jobs.Backfill(ws, store, bulk=bulk, carry_spaces=True)
    run.run(START, START, [rankings.SPACES], lookback=2)
    run.run(END, "2024-01-16", [rankings.SPACES], lookback=2)
    got = store.read(rankings.SPACES)
    assert rows(got.filter(f"ldate <= date'{END}'")) == rows(stores[True].read(rankings.SPACES))
    assert rows(got.filter("ldate = date'2024-01-16'")) == rows(rankings.updated_spaces(ws, Span.of("2024-01-16")))


def late(ws, day):
    """The workspace as it was before a fifth of a day's events had come in."""
    return ws.with_(events=ws.events.filter(f"ldate <> date'{day}' OR pmod(hash(time, user_id), 5) <> 0"))


REPAIRED = [usage.COLLAB_30D_BY_MEMBER.table, usage.PRODUCT_BY_TEAM.table, rankings.HOT_7D, rankings.SPACES]


@pytest.mark.parametrize("carry", [True, False])
def test_gap_between_runs_is_filled(spark, ws, tmp_path, carry):
    store = Store(spark, str(tmp_path))
    jobs.Backfill(ws, store, carry_spaces=carry).run("2024-01-03", tasks=REPAIRED, lookback=2)
    jobs.Backfill(ws, store, carry_spaces=carry).run("2024-01-25", tasks=REPAIRED, lookback=2)
    for table in REPAIRED:
        assert rows(store.read_day(table, "2024-01-25")) == rows(jobs.JOBS[table](ws, Span.of("2024-01-25")))


@pytest.mark.parametrize("carry", [True, False])
def test_late_rows_are_rolled_up(spark, ws, tmp_path, carry):
    store = Store(spark, str(tmp_path))
    jobs.Backfill(late(ws, "2024-01-12"), store, carry_spaces=carry).run("2024-01-13", "2024-01-14", REPAIRED)
    served = []
    run = jobs.Backfill(ws, store, carry_spaces=carry, catch_up=True, serve=lambda task, day, df: served.append((task, day, df.count())))
    run.run(END, tasks=REPAIRED)
    for table in REPAIRED:
        for day in ("2024-01-13", END):
            assert rows(store.read_day(table, day)) == rows(jobs.JOBS[table](ws, Span.of(day)))
    assert {(t, d.day) for t, d, _ in served} == {(t, d) for t in REPAIRED for d in (13, 14, 15)} and all(n for *_, n in served)
