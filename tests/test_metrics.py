"""Golden rows for the traps of the metric definitions."""

import datetime as dt

import pytest
from helpers import DAY, as_set, event, files, membership, one, user_dep, users, workspace
from pyspark.sql import functions as F

from tallyboard import schemas
from tallyboard.operators.periods import Span
from tallyboard.plans import enterprise, rankings, scores, usage
from tallyboard.plans.files import merge_files
from tallyboard.plans.model import enrich_events
from tallyboard.plans.quality import duplicate_users, teams_with_several_memberships

D = Span.of(DAY)


def days_ago(n):
    return DAY - dt.timedelta(n)


def test_team_comes_from_the_user_and_deleted_users_keep_it(spark):
    who = users(spark, [(1, "a", 10, 1, dt.datetime(2023, 1, 1), dt.datetime(2023, 6, 1))])
    ws = workspace(spark, [event("1"), event("2"), event(None)])
    got = as_set(enrich_events(ws.events, who), "user_id", "team_id", "user_name")
    assert got == {("1", 10, "a"), ("2", None, None), (None, None, None)}


def test_null_guid_counts_as_row_only(spark):
    ws = workspace(spark, [event(action="create_obj", guid=None), event(action="create_obj")])
    assert one(usage.usage(ws, usage.FILE_BY_TEAM, D)).create_files == 1
    assert one(usage.usage(ws, usage.COLLAB_BY_TEAM, D)).create_files == 2


def test_clean_team_without_file_acts_has_a_zero_row(spark):
    ws = workspace(spark, [event(action="comment")])
    r = one(usage.usage(ws, usage.FILE_BY_TEAM, D))
    assert (r.create_files, r.import_files, r.upload_files) == (0, 0, 0)
    assert usage.usage(ws, usage.FILE_BY_MEMBER, D).count() == 0


def test_unknown_file_type_counts_for_teams_but_not_members(spark):
    ws = workspace(spark, [event(action="comment", kind=0)])
    assert one(usage.usage(ws, usage.COLLAB_BY_TEAM, D)).comments == 1
    assert usage.usage(ws, usage.COLLAB_BY_MEMBER, D).count() == 0


def test_share_status_is_compared_raw(spark):
    ws = workspace(spark, [event(action="public_share", info='{"status":1}'),
                           event(action="public_share", info='{"status": 1, "x":2}'),
                           event(action="public_share", info='{"status":"1"}'),
                           event(action="public_share", info='{"status":10}'),
                           event(action="public_share", info="{}"),
                           event(action="public_share", info=None)])
    assert one(usage.usage(ws, usage.COLLAB_BY_TEAM, D)).public_shares == 2


def test_one_day_by_default_seven_on_request(spark):
    ws = workspace(spark, [event(action="import_obj", day=days_ago(n)) for n in (0, 6, 7)])
    assert one(usage.usage(ws, usage.FILE_BY_TEAM, D)).import_files == 1
    assert one(usage.usage(ws, usage.FILE_BY_TEAM.window(7), D)).import_files == 2


def test_thirty_day_window_edges(spark):
    ws = workspace(spark, [event(action="at", day=days_ago(n)) for n in (0, 29, 30)])
    assert one(usage.usage(ws, usage.COLLAB_30D_BY_MEMBER, D)).use_ats == 2


def test_seats_only(spark):
    ws = workspace(spark, [event("1"), event("2")], [(1, 10, 1), (2, 10, 0)])
    assert as_set(usage.usage(ws, usage.COLLAB_BY_MEMBER, D), "user_id") == {("1",)}


def test_departments_count_once_per_ancestor(spark):
    ws = workspace(spark, [event("1", "import_obj"), event("2", "import_obj"), event("3", "import_obj")],
                   [(1, 10, 1), (2, 10, 1), (3, 10, 1)],
                   user_dep=user_dep(spark, [("1", "a"), ("1", "root"), ("2", "root")]))
    got = as_set(usage.usage(ws, usage.FILE_BY_DEPARTMENT, D), "department_id", "import_files")
    assert got == {("a", 1), ("root", 2)}


def test_product_buckets_and_ratios(spark):
    subs = [0, -2, -1, -3, -4, -8, -5, -10, -6, -7, -9, -99]
    rows = [event(action="create_obj", kind=2, sub=s, guid=str(s)) for s in subs]
    rows += [event(action="upload_obj", kind=3), event(action="create_obj", kind=3, guid=None),
             event(action="view_file", kind=2)]
    r = one(usage.usage(workspace(spark, rows), usage.PRODUCT_BY_TEAM, D))
    counts = [r[f"create_{n}"] for n in schemas.PRODUCTS]
    assert r.create_objs == 13 and counts == [2, 3, 1, 2, 1, 1, 2]
    assert r.create_sheets_ratio == 3 / 13


def test_ratio_of_nothing_is_zero(spark):
    r = one(usage.usage(workspace(spark, [event(action="create_obj", guid=None)]), usage.PRODUCT_BY_TEAM, D))
    assert r.create_objs == 0 and r.create_docxs_ratio == 0.0


def test_ratio_guards(spark):
    from tallyboard.functions.scalars import change, share

    df = spark.createDataFrame([(0, 0), (3, 0), (3, 4), (4, 4)], "a int, b int")
    got = df.select(share(F.col("a"), F.col("b")).alias("s"), change(F.col("a"), F.col("b")).alias("c")).collect()
    assert [tuple(r) for r in got] == [(0.0, 0.0), (None, None), (0.75, -0.25), (1.0, 0.0)]


# --- seats and activity --------------------------------------------------------------
def seat(i, created, deleted=None, team=10, is_seat=1):
    return (i, f"u{i}", team, is_seat, created, deleted)


def test_seats_created_before_midnight_only(spark):
    midnight = dt.datetime(2024, 1, 15)
    rows = [seat(1, midnight), seat(2, midnight + dt.timedelta(seconds=1)), seat(3, dt.datetime(2023, 5, 5, 12)),
            seat(4, dt.datetime(2023, 5, 5), deleted=dt.datetime(2023, 6, 1)), seat(5, dt.datetime(2023, 5, 5), is_seat=0)]
    got = one(enterprise.activated_seats(users(spark, rows), D))
    assert got.activated_seats == 2


def seats_workspace(spark, rows, **kw):
    return workspace(spark, rows, [(1, 10, 1), (2, 10, 1), (3, 11, 1)],
                     membership=membership(spark, [(10, 2, 4), (11, 1, 9)]), **kw)


def test_active_and_deep_active(spark):
    rows = [event("1", day=days_ago(n)) for n in (0, 1, 6)] + [event("2", day=days_ago(n)) for n in (0, 0, 7)]
    r = one(enterprise.seats_and_activity(seats_workspace(spark, rows), D))  # team 11: wrong category
    assert (r.team_id, r.member_count, r.activated_seats, r.active_uv, r.deep_active_uv) == (10, 4, 2, 2, 1)
    assert r.activated_seats_ratio == 0.5 and r.active_uv_change_ratio is None


def test_change_against_seven_days_earlier(spark):
    ws = seats_workspace(spark, [event("1", day=days_ago(7)), event("1"), event("2")])
    before = enterprise.seats_and_activity(ws, Span.of(days_ago(7)))
    r = one(enterprise.seats_and_activity(ws.with_(snapshot=lambda t: before), D))
    assert (r.before_7d_active_uv, r.active_uv, r.active_uv_change_ratio) == (1, 2, 1.0)
    assert r.activated_seats_change_ratio == 0.0


def test_strict_jobs_need_their_snapshot(spark):
    ws = seats_workspace(spark, [event("1")])
    with pytest.raises(enterprise.MissingSnapshot):
        enterprise.seats_and_activity(ws, D, strict=True)
    with pytest.raises(enterprise.MissingSnapshot):
        enterprise.usage_to_date(ws, D, strict=True)
    with pytest.raises(enterprise.MissingSnapshot):
        enterprise.creation_download(ws, D)


def test_several_memberships_give_several_rows(spark):
    ws = workspace(spark, [event("1")], membership=membership(spark, [(10, 2, 4), (10, 3, 8)]))
    assert enterprise.seats_and_activity(ws, D).count() == 2
    assert as_set(teams_with_several_memberships(ws.membership), "target_id", "cnt") == {(10, 2)}


# --- cumulative totals -----------------------------------------------------------------
def test_totals_rules_of_their_own(spark):
    rows = [event(action="upload_obj", kind=3), event(action="create_obj", kind=3),
            event(action="public_share", info='{"status":1}', guid=None), event(action="public_share", info='{"status":1}')]
    r = one(enterprise.usage_to_date(workspace(spark, rows), D))
    assert (r.create_objs, r.create_clouds, r.public_shares) == (1, 1, 1)


def test_idle_teams_keep_their_total(spark):
    ws = workspace(spark, [event("1", "at", day=days_ago(1)), event("2", "at")], [(1, 10, 1), (2, 11, 1)])
    stored = enterprise.usage_to_date(ws, Span.of(days_ago(1)))
    got = enterprise.usage_to_date(ws.with_(snapshot=lambda t: stored), D)
    assert as_set(got, "team_id", "use_ats") == {(10, 1), (11, 1)}


def test_missing_snapshot_starts_again(spark):
    ws = workspace(spark, [event("1", "at", day=days_ago(1)), event("1", "at")])
    assert one(enterprise.usage_to_date(ws, D)).use_ats == 1


# --- rankings ----------------------------------------------------------------------------
def test_unknown_and_nameless_files_leave_before_ranking(spark):
    rows = [event(guid="gone")] * 5 + [event(guid="noname")] * 4 + [event(guid="b")] * 2 + [event(guid="a")] * 2
    ws = workspace(spark, rows, files=files(spark, [("a", "A", "2", "0"), ("b", "B^x", "3", "0"), ("noname", None, "2", "0")]))
    got = [(r.guid, r.name, r.file_views, r.row_number) for r in rankings.hot_files(ws, D).orderBy("row_number").collect()]
    assert got == [("a", "A", 2, 1), ("b", "B^x", 2, 2)]


def test_hot_files_are_cut_at_one_hundred_per_team(spark):
    rows = [event(u, guid=f"{i:03d}") for i in range(101) for u in ("1", "2")]
    ws = workspace(spark, rows, [(1, 10, 1), (2, 11, 1)],
                   files=files(spark, [(f"{i:03d}", "n", "2", "0") for i in range(101)]))
    got = rankings.hot_files(ws, D)
    assert got.count() == 200
    assert as_set(got.groupBy("team_id").agg(F.max("guid").alias("g")), "team_id", "g") == {(10, "099"), (11, "099")}


def space(user, guid, day=DAY, seconds=0):
    return event(user, "view_file", kind=1, sub=2, guid=guid, day=day, seconds=seconds)


def test_spaces_latest_act_and_global_cut(spark):
    rows = [space("1", "s1", days_ago(400)), space("1", "s1", days_ago(3), 5), space("1", None), space("2", "s2"),
            space("2", "later", DAY + dt.timedelta(1)), event("1", kind=1, sub=1, guid="folder")]
    ws = workspace(spark, rows, [(1, 10, 1), (2, 11, 1)], files=files(spark, [("s1", "S", "1", "2")]))
    got = rankings.updated_spaces(ws, D).collect()
    assert [(r.team_id, r.guid, r.name) for r in got] == [(10, None, None), (10, "s1", "S"), (11, "s2", None)]
    assert got[1].updated_at == dt.datetime(2024, 1, 12, 0, 0, 5)
    assert [(r.team_id, r.guid) for r in rankings.updated_spaces(ws, D, n=2).collect()] == [(10, None), (10, "s1")]
    assert as_set(rankings.updated_spaces(ws, D, n=1, per_team=True), "team_id", "guid") == {(10, None), (11, "s2")}


def test_spaces_with_several_names_are_cut_like_rows(spark):
    ws = workspace(spark, [space("1", "s1", seconds=9), space("1", "s2", seconds=5)],
                   files=files(spark, [("s1", "B", "1", "2"), ("s1", "A", "1", "2"), ("s1", "A", "1", "2"), ("s2", "C", "1", "2")]))
    for n, want in ((1, ["A"]), (2, ["A", "B"]), (3, ["A", "B", "C"])):
        assert [r.name for r in rankings.updated_spaces(ws, D, n=n).collect()] == want


# --- downloads -----------------------------------------------------------------------------
def test_member_download_repeats_per_department(spark):
    rows = [event("1", "view_file"), event("1", "create_obj", kind=1, sub=2), event("1", "create_obj", kind=1, sub=1),
            event("1", "create_obj", kind=2), event("2", "comment")]
    ws = workspace(spark, rows, [(1, 10, 0), (2, 10, 0)], user_dep=user_dep(spark, [("1", "a"), ("1", "b")]))
    got = usage.member_usage_download(ws, D)
    assert as_set(got, "user_id", "department_id", "create_spaces", "create_dirs", "create_files", "active_score") == {
        ("1", "a", 1, 1, 1, 11), ("1", "b", 1, 1, 1, 11), ("2", None, 0, 0, 0, 5)}


def test_creation_download_looks_back_seven_days(spark):
    ws = workspace(spark, [event(action="create_obj", day=days_ago(n)) for n in (0, 6, 7)],
                   membership=membership(spark, [(10, 2, 4)]))
    tables = {enterprise.USERS_TABLE: enterprise.seats_and_activity(ws, D),
              enterprise.TOTALS_TABLE: enterprise.usage_to_date(ws, Span.of(days_ago(7), DAY))}
    r = one(enterprise.creation_download(ws.with_(snapshot=tables.get), D))
    assert (r.create_objs, r.total_create_objs, r.member_count, r.activated_seats) == (2, 3, 4, 1)


def test_scores(spark):
    totals = spark.createDataFrame([(DAY, 10, 10, 1440, 1, 2, 3)],
                                   "ldate date, team_id long, create_objs long, file_views long, public_shares long, "
                                   "add_collaborations long, comments long")
    assert one(scores.auto_save_count(totals)).auto_saves == 2 * 7 + 10 + 45
    assert one(scores.save_time(totals)).save_time == (1440 + 300 + 10 + 30 + 9) / 1440


# --- file dimension ---------------------------------------------------------------------------
def test_file_merge(spark):
    def src(*rows):
        return spark.createDataFrame([(g, n, 2, 0, 5, "1", d) for g, n, d in rows], schemas.FILE_SOURCE)

    gone = dt.datetime(2024, 1, 1)
    got = merge_files(src(("a", "x", None), ("a", "y", None), ("c", "dead", gone), (None, "z", None)),
                      src(("a", "old", None), ("b", "old", None), ("c", "old", None)))
    assert sorted(map(tuple, got.select("guid", "name", "file_loc").collect())) == [
        ("a", "x", "space"), ("a", "y", "space"), ("b", "old", "desktop"), ("c", "old", "desktop")]
    r = got.first()
    assert (r.updated_at, r.updated_by, r.deleted_at, r.deleted_by, r.file_type) == (-1, "null", -1, "null", "2")


def test_user_audit(spark):
    assert duplicate_users(users(spark, [(1, 10, 1), (1, 11, 1), (2, 10, 1)])).count() == 1
