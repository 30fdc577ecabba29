"""Organisation graph: user-to-department bridge and views on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import joined_text
from ..operators.closure import ancestors, maintain
from ..operators.joins import salted_inner_join
from ..sources.scratch import cut_lineage

# Node types of the graph.
ENTERPRISE, DEPARTMENT, USER = 9, 10, 11


def _node(kind: str, ident: str) -> Column:
    return F.struct(F.col(kind).cast("int").alias("type"), F.col(ident).cast("bigint").alias("id"))


def org_edges(edges: DataFrame, include_links: bool = True) -> DataFrame:
    """Live edges with compound (type, id) keys: ``node``, ``parent``."""
    live = edges.filter(F.col("node_type").isin(ENTERPRISE, DEPARTMENT, USER) & ~F.col("is_removed"))
    if not include_links:
        live = live.filter(~F.col("is_link"))
    return live.select(_node("node_type", "node_id").alias("node"),
                       _node("parent_type", "parent_id").alias("parent"))


def user_departments(edges: DataFrame, include_links: bool = True, max_depth: int | None = None) -> DataFrame:
    """``user_dep``: every user with every department or enterprise above it, once.

    The closure runs over the departments users hang on, a graph far smaller than the
    user edges; users meet it in one join at the end. That join is on the direct
    department, which may hold a third of all users, hence the salting.
    """
    graph = org_edges(edges, include_links)
    is_user = F.col("node.type") == USER
    direct = cut_lineage(graph.filter(is_user)  # read three times below, scanned once
                         .select(F.col("node.id").alias("user"), F.col("parent").alias("seed"))
                         .distinct())
    above = ancestors(direct.select(F.col("seed").alias("node")), graph.filter(~is_user), max_depth)
    return (salted_inner_join(direct, above, ["seed"], spread_by=F.col("user"))
            .select(F.col("user").cast("string").alias("user_id"),
                    F.col("anc.id").cast("string").alias("department_id")).distinct())


def bridge_closure(edges: DataFrame, include_links: bool = True) -> DataFrame:
    """The closure ``update_user_departments`` maintains: departments users hang on, with all above them."""
    graph = org_edges(edges, include_links)
    is_user = F.col("node.type") == USER
    return ancestors(graph.filter(is_user).select(F.col("parent").alias("node")), graph.filter(~is_user))


def update_user_departments(bridge: DataFrame, closure: DataFrame, old_edges: DataFrame, new_edges: DataFrame,
                            include_links: bool = True) -> tuple[DataFrame, DataFrame]:
    """``user_dep`` and its closure after a change of edges; both equal a full rebuild.

    The closure is maintained by delete and rederive. Rows are made anew for users whose own edges changed
    or who hang on a department with changed pairs; the rows of all others are kept.
    """
    old, new = org_edges(old_edges, include_links), org_edges(new_edges, include_links)
    is_user = F.col("node.type") == USER

    def direct(graph: DataFrame) -> DataFrame:
        return cut_lineage(graph.filter(is_user).select(
            F.col("node.id").alias("user"), F.col("parent").alias("seed")).distinct())

    before, now = direct(old), direct(new)
    change = maintain(closure, now.select(F.col("seed").alias("node")), old.filter(~is_user), new.filter(~is_user))
    pairs = cut_lineage(change.pairs)
    moved = (before.join(now, ["user", "seed"], "left_anti")
             .unionByName(now.join(before, ["user", "seed"], "left_anti")).select("user"))
    turned = change.removed.select("seed").unionByName(change.added.select("seed")).distinct()
    affected = cut_lineage(moved.unionByName(now.join(turned, "seed", "left_semi").select("user")).distinct())
    remade = (salted_inner_join(now.join(affected, "user", "left_semi"), pairs, ["seed"], spread_by=F.col("user"))
              .select(F.col("user").cast("string").alias("user_id"),
                      F.col("anc.id").cast("string").alias("department_id")).distinct())
    same = bridge.join(affected.select(F.col("user").cast("string").alias("user_id")), "user_id", "left_anti")
    return same.select("user_id", "department_id").unionByName(remade), pairs


def department_lists(user_dep: DataFrame) -> DataFrame:
    """Departments of each user as one comma list."""
    return joined_text(user_dep, ["user_id"], "department_id", "deps")


def organizations(edges: DataFrame) -> DataFrame:
    """Team to department, full-joined with department to user. Removed edges included.

    Written as left join plus anti join: unlike a full join, Spark can split the left side
    when one department holds a large share of the users.
    """
    teams = (edges.filter((F.col("parent_type") == ENTERPRISE) & (F.col("node_type") == DEPARTMENT))
             .select(F.col("parent_id").alias("team_id"), F.col("node_id").alias("department_id")))
    members = (edges.filter((F.col("parent_type") == DEPARTMENT) & (F.col("node_type") == USER))
               .select(F.col("parent_id").alias("_dep"), F.col("node_id").cast("string").alias("user_id")))
    same = F.col("_dep") == F.col("department_id")
    with_members = members.join(teams, same, "left")
    empty = teams.join(members.select("_dep").distinct(), same, "left_anti")
    return (with_members.select("team_id", "department_id", "user_id")
            .unionByName(empty.withColumn("user_id", F.lit(None).cast("string"))))
