"""Maps the synthetic tables to the logical inputs of the engine (see FIXTURES.md, part B)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.functions.scalars import local_to_epoch_millis
from tallyboard.plans.files import merge_files
from tallyboard.plans.model import Workspace
from tallyboard.plans.org import user_departments
from tallyboard.sources.scratch import scratch_path

DATE = "2024-01-15"
FIRST_DATE = "2024-01-01"
CUTOFF = "2024-01-10"  # last day of the "older systems" in the history queries


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _guid(event_id):
    """File of an event: ever more files as the table grows, each touched by ten events."""
    return event_id % 300 + 300 * F.floor(event_id / 3000)


def _creator(part_key):
    return part_key % 15 + 15 * F.floor(part_key / 200)


def shape_events(raw: DataFrame) -> DataFrame:
    """Also used on a streaming read of the same file."""
    k, e = F.get_json_object("props", "$.k").cast("int"), F.col("event_id")
    ts = F.col("ts").cast("timestamp_ntz")
    t = F.col("event_type")

    def one_of(*names: str):
        return F.element_at(F.array(*[F.lit(n) for n in names]), k % 3 + 1)

    kind = F.when(t == "error", F.lit(0)).otherwise((1 + (e + k) % 3).cast("int"))
    action = (F.when(t == "signup", "create_obj").when(t == "view", "view_file")
              .when(t == "purchase", one_of("import_obj", "upload_obj", "add_collaborator"))
              .when(t == "click", one_of("comment", "at", "public_share")).otherwise("unknown"))
    return raw.select(
        F.to_date(ts).alias("ldate"), t.alias("event_type"),
        F.when(e % 97 == 0, F.lit(None)).otherwise(_guid(e).cast("string")).alias("guid"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("d"), (e % 7).cast("string")).alias("device_id"),
        kind.alias("file_type"),
        F.when(kind == 2, -(e % 11)).when(kind == 1, 1 + e % 2).otherwise(0).cast("int").alias("sub_type"),
        local_to_epoch_millis(ts).alias("time"), action.alias("action_name"),
        F.lit(None).cast("string").alias("action_param"),
        F.when(e % 3 == 0, "MobileShell/1.0").otherwise("Browser/1.0").alias("user_agent"),
        F.when((t == "click") & (k % 3 == 2),
               F.when(k % 2 == 0, '{"status":1}').otherwise('{"status":"1"}')).otherwise("{}")
        .alias("extend_info"),
        F.lit(0).cast("bigint").alias("team_id"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_events(table(spark, sf_dir, "events"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        c.alias("id"), F.col("c_name").alias("name"),
        F.when(c % 7 == 0, F.lit(None)).otherwise(c % 10).alias("team_id"),
        F.when(c % 3 != 0, 1).otherwise(0).alias("is_seat"),
        F.date_add(F.lit(dt.date(2023, 12, 1)), (c % 60).cast("int")).cast("timestamp_ntz").alias("created_at"),
        F.when(c % 11 == 0, F.lit(dt.date(2024, 1, 10))).cast("timestamp_ntz").alias("deleted_at"))


def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey").cast("bigint")
    return table(spark, sf_dir, "nation").select(
        n.alias("target_id"), (1 + n % 4).cast("int").alias("category"),
        (5 * (n + 1)).alias("member_count"), F.lit(None).cast("timestamp_ntz").alias("deleted_at"))


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey").cast("bigint")
    return table(spark, sf_dir, "nation").select(
        (100 + n).alias("id"), F.col("n_name").alias("name"), (n % 10).alias("team_id"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    customers = table(spark, sf_dir, "customer")

    def edge(df, kind, node, parent_kind, parent, removed):
        return df.select(
            F.lit(kind).alias("node_type"), node.alias("node_id"),
            parent_kind.alias("parent_type"), parent.cast("bigint").alias("parent_id"),
            F.lit(0).cast("bigint").alias("version"), F.lit(0).cast("bigint").alias("order"),
            F.lit(False).alias("is_link"), removed.alias("is_removed"))

    removed = c % 13 == 0
    direct = edge(customers, 11, c, F.lit(10), 100 + c % 25, removed)
    second = edge(customers.filter("c_custkey % 5 = 0"), 11, c, F.lit(10), 100 + (c + 7) % 25, removed)
    n = F.col("n_nationkey").cast("bigint")
    nations = table(spark, sf_dir, "nation")
    deps = edge(nations, 10, 100 + n, F.when(n < 4, 9).otherwise(10),
                F.when(n < 4, 900 + n % 2).otherwise(100 + F.floor(n / 4)), F.lit(False))
    return direct.unionByName(second).unionByName(deps)


def file_source(spark: SparkSession, sf_dir: str, every: int) -> DataFrame:
    """Current files are the even parts (every=2), legacy files each third one (every=3)."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").filter(k % every == 0).select(
        k.cast("string").alias("guid"), F.when(k % 50 != 48, F.col("p_name")).alias("name"),
        (2 + F.floor((k % 4) / 2)).cast("int").alias("type"), (-(k % 11)).cast("int").alias("sub_type"),
        (1704067200 + k * 600).alias("created_at"), _creator(k).cast("string").alias("created_by"),
        F.lit(None).cast("timestamp_ntz").alias("deleted_at"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_files(file_source(spark, sf_dir, 2), file_source(spark, sf_dir, 3))


def user_dep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bridge as jobs read it: built and stored once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BRIDGES:
        path = scratch_path(spark, "user-dep")
        user_departments(edges(spark, sf_dir)).write.parquet(path)
        _BRIDGES[key] = path
    return spark.read.schema("user_id string, department_id string").parquet(_BRIDGES[key])


_BRIDGES: dict[tuple[str, str], str] = {}


def workspace(spark: SparkSession, sf_dir: str, *parts: str) -> Workspace:
    """Events and users, plus the named dimensions."""
    makers = {"membership": membership, "departments": departments,
              "user_dep": user_dep, "files": files}
    return Workspace(events(spark, sf_dir), users(spark, sf_dir),
                     **{p: makers[p](spark, sf_dir) for p in parts})


# --- older systems (history queries) -------------------------------------------
def dated_users(spark: SparkSession, sf_dir: str, *dates: str) -> DataFrame:
    return users(spark, sf_dir).withColumn(
        "ldate", F.explode(F.array(*[F.lit(dt.date.fromisoformat(d)) for d in dates])))


def full_copies(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    cut = F.lit(dt.date.fromisoformat(CUTOFF))
    raw = table(spark, sf_dir, "events")
    return {
        # some customers have no user row after the shift
        "permissions": table(spark, sf_dir, "orders").select(
            (F.col("o_custkey") + 20).alias("user_id"), cut.alias("ldate")),
        "notifications": table(spark, sf_dir, "lineitem").select(
            F.col("l_suppkey").alias("user_id"), cut.alias("ldate")),
        "comments": table(spark, sf_dir, "conversations").select(
            F.col("conv_id").alias("user_id"), cut.alias("ldate")),
        "share_events": raw.select(
            F.col("user_id").cast("string").alias("user_id"),
            F.when(F.col("event_id") % 3 == 0, "private").otherwise("public").alias("end_mode"),
            F.to_date("ts").alias("ldate")),
    }


def client_log(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    e = F.col("event_id")
    kinds = {"web": ("$pageview", "app_webview", "click", "$pageview"),
             "wx": ("wx_openfile", "wx_share", "wx_openfile", "wx_login"),
             "app": ("appView", "app_webview", "appStart", "appView")}[source]
    pages = ("docs", "sheets", "folder", "home", "space", "login", "slides", "forms")

    def pick(values, index):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))

    guid = F.lpad(_guid(e).cast("string"), 16, "0")
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("ldate"), F.col("user_id").cast("string").alias("client_user_id"),
        F.when(e % 5 == 0, _guid(e).cast("string")).otherwise(guid).alias("guid"),
        pick(kinds, F.floor(e / 2)).alias("event_type"),
        F.when(e % 3 == 0, "MobileShell/1.0").otherwise("Browser/1.0").alias("user_agent"),
        F.concat(F.lit("/"), pick(pages, F.floor(e / 8)), F.lit("/"), guid).alias("s_url_path"))


def old_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Dated copies of the two file systems; both hold exact duplicates."""
    cut = F.lit(dt.date.fromisoformat(CUTOFF))
    k, o, c = F.col("p_partkey"), F.col("o_orderkey"), F.col("o_custkey")
    new = table(spark, sf_dir, "part").select(
        _creator(k).alias("created_by"), (1 + k % 3).cast("int").alias("type"),
        (-(k % 11)).cast("int").alias("sub_type"), F.floor(k / 2).cast("string").alias("guid"),
        cut.alias("ldate"))
    legacy = table(spark, sf_dir, "orders").select(
        F.when(c % 7 == 0, F.lit(None)).otherwise(c % 10).alias("team_id"), c.alias("user_id"),
        (2 - o % 14).cast("int").alias("type"), F.concat(F.lit("L"), F.floor(o / 3).cast("string")).alias("guid"),
        cut.alias("ldate"))
    return new, legacy


def seat_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("o_orderkey")
    kinds = F.array(*[F.lit(v) for v in ("新增", "增购", "云SDK", "升级", "续费")])
    start = F.to_date(F.col("o_orderdate").cast("timestamp_ntz"))
    return table(spark, sf_dir, "orders").select(
        F.element_at(kinds, (o % 5 + 1).cast("int")).alias("order_type"),
        (1 + o % 50).cast("int").alias("total_seats"), start.alias("order_start_date"),
        F.date_add(start, (o % 400).cast("int")).alias("order_end_date"))
