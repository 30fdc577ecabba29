import pytest
from helpers import as_set, edges

from tallyboard.operators.closure import ancestors
from tallyboard.plans.org import department_lists, organizations, user_departments


def deps_of(spark, pairs, **kw):
    out = {}
    for u, d in as_set(user_departments(edges(spark, pairs, **kw)), "user_id", "department_id"):
        out.setdefault(int(u), set()).add(int(d))
    return out


def dep(n):
    return (10, n)


def ent(n):
    return (9, n)


def usr(n):
    return (11, n)


def test_chain_to_the_root(spark):
    pairs = [(usr(12784), dep(279)), (usr(12784), ent(945)), (dep(279), dep(278)), (dep(278), dep(277)),
             (dep(277), dep(270)), (dep(270), ent(945))]
    assert deps_of(spark, pairs) == {12784: {279, 278, 277, 270, 945}}


def test_several_parents(spark):
    u = usr(6003920)
    pairs = [(u, ent(183141)), (u, dep(2644)), (u, dep(2649)), (u, dep(2650)), (u, dep(2652)), (u, dep(2692)),
             (dep(2644), ent(183141)), (dep(2649), dep(2644)), (dep(2650), dep(2649)), (dep(2652), dep(2646)),
             (dep(2646), ent(183141)), (dep(2692), dep(2691)), (dep(2691), ent(183141))]
    assert deps_of(spark, pairs) == {6003920: {183141, 2644, 2646, 2649, 2650, 2652, 2691, 2692}}


def test_single_line(spark):
    assert deps_of(spark, [(usr(5001500), dep(43)), (dep(43), ent(1007))]) == {5001500: {43, 1007}}


def test_removed_edges_and_dangling_parent(spark):
    gone = (dep(1), dep(2))
    pairs = [(usr(1), dep(1)), gone, (usr(2), dep(99))]
    assert deps_of(spark, pairs, removed=[gone]) == {1: {1}, 2: {99}}


def test_cycle_ends(spark):
    assert deps_of(spark, [(usr(1), dep(1)), (dep(1), dep(2)), (dep(2), dep(1))]) == {1: {1, 2}}


def test_diamond_gives_each_pair_once(spark):
    pairs = [(usr(1), dep(1)), (dep(1), dep(2)), (dep(1), dep(3)), (dep(2), dep(4)), (dep(3), dep(4))]
    rows = user_departments(edges(spark, pairs)).collect()
    assert sorted(int(r.department_id) for r in rows) == [1, 2, 3, 4]


def test_same_id_of_other_type_is_another_node(spark):
    # enterprise 5 has a parent, department 5 has none
    pairs = [(usr(1), dep(5)), (ent(5), ent(6)), (usr(2), ent(5))]
    assert deps_of(spark, pairs) == {1: {5}, 2: {5, 6}}


def test_links_count_unless_left_out(spark):
    link = (dep(1), dep(2))
    graph = edges(spark, [(usr(1), dep(1)), link], links=[link])
    assert as_set(user_departments(graph), "department_id") == {("1",), ("2",)}
    assert as_set(user_departments(graph, include_links=False), "department_id") == {("1",)}


def test_depth_guard(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(6)], "node long, parent long")
    with pytest.raises(ValueError):
        ancestors(chain.select("node").limit(1), chain, max_depth=2)


def test_many_users_on_one_department(spark):
    pairs = [(usr(i), dep(1)) for i in range(500)] + [(dep(1), dep(2)), (dep(2), ent(3))]
    got = deps_of(spark, pairs)
    assert len(got) == 500 and all(v == {1, 2, 3} for v in got.values())


def test_department_lists(spark):
    graph = edges(spark, [(usr(1), dep(1)), (dep(1), dep(2))])
    assert as_set(department_lists(user_departments(graph)), "user_id", "deps") == {("1", "1,2")}


def test_organizations_keeps_both_sides(spark):
    pairs = [(dep(1), ent(7)), (dep(2), ent(7)), (usr(5), dep(1)), (usr(6), dep(3))]
    assert as_set(organizations(edges(spark, pairs)), "team_id", "department_id", "user_id") == {
        (7, 1, "5"), (7, 2, None), (None, None, "6")}
