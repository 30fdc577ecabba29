"""Exports and external sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import DateLike, as_date

JDBC_BATCH = 1000


def write_events(events: DataFrame, path: str, mode: str = "append") -> None:
    """Event table partitioned by day. The rebalance lets AQE split large days over many
    tasks and gather small ones, so file sizes follow the data.

    A folder that a stream writes is refused: readers take only the files its log names, so rows
    appended beside it would be invisible.
    """
    folder = events.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_spark_metadata")
    if folder.getFileSystem(events.sparkSession._jsc.hadoopConfiguration()).exists(folder):
        raise ValueError(f"{path} belongs to a stream; write elsewhere and read both")
    events.hint("rebalance", "ldate").write.mode(mode).partitionBy("ldate").parquet(path)


def escape_lines(text: Column) -> Column:
    r"""Backslashes doubled, line feeds and carriage returns written as ``\n`` and ``\r``."""
    out = text
    for char, mark in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(char), F.lit(mark))
    return out


def write_csv(df: DataFrame, path: str, *, header: bool = True, sep: str = ",", escaped: bool = False) -> None:
    r"""Delimited text export; quotes are doubled inside quoted fields, lists become text.

    ``escaped`` keeps every row on one line whatever its fields hold, so that files can be split:
    line ends and backslashes are escaped (``escape_lines``). Without it a line end stays inside its quotes, and
    only ``read_csv(multiline=True)`` reads such a file. An escaped file marks NULL by ``\N`` and so tells it from
    an empty text; in a plain one both are read as NULL. Blanks around a value and empty texts are kept.
    """
    def flat(f) -> Column:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() == "array":
            c = F.array_join(c, ",")
        elif not isinstance(f.dataType, T.StringType):
            return c
        return escape_lines(c) if escaped else c

    (df.select(*[flat(f).alias(f.name) for f in df.schema])
     .write.mode("overwrite").option("header", header).option("sep", sep)
     .options(**({"nullValue": "\\N"} if escaped else {}))
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("quote", '"').option("escape", '"').csv(path))


def write_escaped_tsv(df: DataFrame, path: str) -> None:
    r"""Tab-separated text with ``\N`` for NULL and backslash escapes, one line per row whatever the fields hold."""
    def text(c: str):
        out = F.col(c).cast("string")
        for char, mark in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
            out = F.replace(out, F.lit(char), F.lit(mark))
        return F.coalesce(out, F.lit("\\N"))

    df.select(F.array_join(F.array(*[text(c) for c in df.columns]), "\t").alias("value")).write.mode("overwrite").option("lineSep", "\n").text(path)


def create_partitioned_table(spark: SparkSession, table: str, columns: str, location: str) -> None:
    """External Parquet table partitioned by the text column ``ldate``."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, ldate STRING) "
              f"USING parquet PARTITIONED BY (ldate) LOCATION '{location}'")


def insert_overwrite(df: DataFrame, table: str) -> None:
    """Dynamic-partition overwrite: only the dates present in ``df`` are replaced."""
    spark = df.sparkSession
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        columns = spark.table(table).columns
        df.select(*[F.col(c).cast("string") if c == "ldate" else F.col(c) for c in columns]) \
          .write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(key, before)


def jdbc_delete_day(connection, table: str, sql_date) -> None:
    """Delete one date over an open JDBC connection and close it."""
    try:
        statement = connection.prepareStatement(f"DELETE FROM {table} WHERE ldate = ?")
        statement.setDate(1, sql_date)
        statement.executeUpdate()
    finally:
        connection.close()


def write_jdbc_day(df: DataFrame, url: str, table: str, date: DateLike,
                   properties: Mapping[str, str] | None = None, writers: int = 8) -> None:
    """Replace one date of a serving table: delete it, then insert in batches of 1000.

    NULLs stay NULLs. At most ``writers`` connections write at a time; fewer partitions are
    left as they are. Needs the JDBC driver of the target on the class path.
    """
    jvm = df.sparkSession._jvm
    props = {"batchsize": str(JDBC_BATCH), **(properties or {})}
    jprops = jvm.java.util.Properties()
    for k, v in props.items():
        jprops.setProperty(k, v)
    jdbc_delete_day(jvm.java.sql.DriverManager.getConnection(url, jprops), table,
                    jvm.java.sql.Date.valueOf(as_date(date).isoformat()))
    (df.filter(F.col("ldate") == F.lit(as_date(date))).write.mode("append")
     .option("numPartitions", writers).jdbc(url, table, properties=props))
