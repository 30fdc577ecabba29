"""Runs that break and go on."""

import pytest

from checks import fixtures as fx
from tallyboard import run_jobs
from tallyboard.operators.periods import Span
from tallyboard.plans import enterprise, jobs, rankings, usage
from tallyboard.plans.journal import Journal, state_of
from tallyboard.sources.store import Store

START, END = "2024-01-14", "2024-01-15"
TASKS = [usage.PRODUCT_BY_TEAM.table, enterprise.TOTALS_TABLE, rankings.SPACES]
PAIRS = [(t, d) for d in (14, 15) for t in TASKS]


class Break(Exception):
    pass


@pytest.fixture(scope="module")
def ws(spark, sf_dir):
    return fx.workspace(spark, sf_dir, "membership", "departments", "files")


@pytest.fixture(scope="module")
def whole(spark, ws, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("whole")))
    jobs.Backfill(ws, store, bulk=False).run(START, END, TASKS)
    return {t: rows(store.read(t)) for t in TASKS}


def rows(df):
    return sorted(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def test_a_run_broken_after_every_step_computes_each_step_once(spark, ws, whole, tmp_path, monkeypatch):
    store, computed = Store(spark, str(tmp_path)), []
    write = Store.write_span

    def counted(self, df, table, span):
        if table in TASKS and computed and computed[-1] == "fresh":
            computed[-1] = (table, span.start.day)
            write(self, df, table, span)
        elif table in TASKS:
            raise Break  # the second step of each start
        else:
            write(self, df, table, span)

    monkeypatch.setattr(Store, "write_span", counted)
    for _ in PAIRS[:-1]:
        computed.append("fresh")
        with pytest.raises(Break):
            jobs.Backfill(ws, store, bulk=False, carry_spaces=True, name="nightly").run(START, END, TASKS)
    computed.append("fresh")
    jobs.Backfill(ws, store, bulk=False, carry_spaces=True, name="nightly").run(START, END, TASKS)
    assert computed == PAIRS
    jobs.Backfill(ws, store, bulk=False, carry_spaces=True, name="nightly").run(START, END, TASKS)  # nothing left, so no step breaks
    assert {t: rows(store.read(t)) for t in TASKS} == whole


def test_a_step_that_was_stored_but_not_served_is_done_again(spark, ws, whole, tmp_path):
    store, served = Store(spark, str(tmp_path)), []

    def serve(task, day, df):
        served.append((task, day.day))
        if len(served) == 2:
            raise Break

    with pytest.raises(Break):
        jobs.Backfill(ws, store, bulk=False, name="n", serve=serve).run(START, END, TASKS)
    jobs.Backfill(ws, store, bulk=False, name="n", serve=serve).run(START, END, TASKS)
    assert served == [PAIRS[0], PAIRS[1], *PAIRS[1:]]
    assert {t: rows(store.read(t)) for t in TASKS} == whole


@pytest.mark.parametrize("breaks_at", ["the ledger", "the reports"])
def test_late_days_are_not_forgotten_by_a_break(spark, ws, tmp_path, monkeypatch, breaks_at):
    """The first start rolls the late day up and breaks; the second one still redoes the stored reports."""
    store, tasks, replace = Store(spark, str(tmp_path)), [usage.PRODUCT_BY_TEAM.table], Store.replace
    before = ws.with_(events=ws.events.filter("ldate <> date'2024-01-12' OR pmod(hash(time, user_id), 5) <> 0"))
    jobs.Backfill(before, store).run(START, tasks=tasks)
    with monkeypatch.context() as m:
        if breaks_at == "the ledger":
            m.setattr(Store, "replace", lambda self, df, table: (replace(self, df, table), (_ for _ in ()).throw(Break())))
        else:
            m.setattr(Store, "write_span", lambda *a: (_ for _ in ()).throw(Break()))
        with pytest.raises(Break):
            jobs.Backfill(ws, store, catch_up=True, name="late").run(END, tasks=tasks)
    jobs.Backfill(ws, store, catch_up=True, name="late").run(END, tasks=tasks)
    for day in (START, END):
        assert rows(store.read_day(tasks[0], day)) == rows(jobs.JOBS[tasks[0]](ws, Span.of(day)))


def test_late_rows_open_a_finished_step_again(spark, ws, tmp_path):
    store, tasks, served = Store(spark, str(tmp_path)), [usage.PRODUCT_BY_TEAM.table], []
    before = ws.with_(events=ws.events.filter("ldate <> date'2024-01-15' OR pmod(hash(time, user_id), 5) <> 0"))
    for events in (before, before, ws, ws):
        jobs.Backfill(events, store, bulk=False, name="n", serve=lambda t, d, df: served.append(d.day)).run(START, END, tasks)
    assert served == [14, 15, 15]
    assert rows(store.read_day(tasks[0], END)) == rows(jobs.JOBS[tasks[0]](ws, Span.of(END)))


def test_state_looks_at_days_up_to_the_report():
    a, b = Span.of("2024-01-01", "2024-01-02").dates()
    assert state_of({"t": {a: 1, b: 2}}, a) == state_of({"t": {a: 1}}, a) != state_of({"t": {a: 2}}, a)


@pytest.mark.parametrize("name", ["../x", "", ".hidden", "a/b", "a@b"])
def test_names_of_runs(spark, tmp_path, name):
    with pytest.raises(ValueError):
        Journal(Store(spark, str(tmp_path)), name)


def test_main_rebuilds_dimensions_once_and_stores_the_tasks(spark, sf_dir, whole, tmp_path, monkeypatch):
    frames = {"events": fx.events(spark, sf_dir), "users": fx.users(spark, sf_dir), "edges": fx.edges(spark, sf_dir),
              "files_current": fx.file_source(spark, sf_dir, 2), "files_legacy": fx.file_source(spark, sf_dir, 3)}
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/in/{name}")
    args = run_jobs.arguments(["--input", f"{tmp_path}/in", "--store", f"{tmp_path}/out", "--start", START, "--end", END,
                               "--tasks", ",".join((TASKS[0], TASKS[2])), "--run", "r1", "--dimensions", "--day-by-day"])
    store = run_jobs.run(spark, args)
    assert rows(store.read(TASKS[0])) == whole[TASKS[0]] and rows(store.read(TASKS[2])) == whole[TASKS[2]]
    monkeypatch.setattr(jobs, "refresh_dimensions", lambda *a: pytest.fail("dimensions were finished"))
    run_jobs.run(spark, args)
    assert store.read_dimension("user_dep").count() == fx.user_dep(spark, sf_dir).count()
