"""Typed readers and writers of the stored tables: plain Parquet folders.

Logs only grow. A run's rows lie under the day it began and a hash of its id (``run_day``, ``run_bucket``), then under the load
that wrote them. A load is one micro-batch of one stream, or one replay; writing it again replaces its own folders.

States hold one row per key, in ``bucket`` folders by a hash of the key. A load reads the buckets that its keys fall into and writes
them anew, by Spark's dynamic partition overwrite. Every row carries the load that wrote it and the row before that load
(``prior``), so a load that is repeated starts from the same rows as the first time. One writer at a time: a load that failed
is repeated before another one begins.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.schemas import ATTEMPT_PAGES, LANDED_PAGE, MEDIA_ASSETS, MEDIA_POSTS, OBSERVATION, SYNC_RUNS, TABLES, TRACKED_COLUMNS
from postlake.session import staged

# Folders that a state is spread over, and runs of a day. A small micro-batch touches few of them; a large lake wants more.
BUCKETS = 32
RUN_BUCKETS = 4

_RUN_FOLDERS = T.StructType().add("run_day", "string").add("run_bucket", "integer").add("load", "string")
_LOAD_FOLDER = T.StructType().add("load", "string")

_ROUTED = T.StructType()
for _name in ("message_id", "body", "route", "kind", "hashtag_id", "media_id"):
    _ROUTED.add(_name, "string")

# Log tables beside those that the schemas name.
EXTRA = {
    "page_quarantine": T.StructType(list(LANDED_PAGE.fields)).add("reason", "string"),
    "item_quarantine": T.StructType()
    .add("sync_run_id", "string").add("hashtag_id", "string").add("source", "string").add("position_overall", "integer")
    .add("fetched_at", "timestamp").add("payload", "string").add("errors", T.ArrayType(T.StringType())),
    "download_jobs": T.StructType().add("type", "string").add("media_id", "string").add("url", "string"),
    "jobs": _ROUTED,
    "dead_letter": _ROUTED,
    "parked": T.StructType().add("message_id", "string").add("deliveries", "long").add("parked_at", "timestamp"),
}
FOLDERS = {
    "data_points": _RUN_FOLDERS, "page_quarantine": _RUN_FOLDERS, "item_quarantine": _RUN_FOLDERS,
    "media_post_history": _RUN_FOLDERS, "download_jobs": _LOAD_FOLDER, "jobs": _LOAD_FOLDER, "dead_letter": _LOAD_FOLDER, "parked": _LOAD_FOLDER,
}

_POST_TYPES = {f.name: f.dataType for f in OBSERVATION.fields} | {"rank": T.IntegerType()}
# The newest history row of a post, as far as later observations are compared with it. Ordered by arrival.
RECORDED_COLUMNS = ("fetched_at", "sync_run_id", "position_overall", *TRACKED_COLUMNS)
_RECORDED = T.StructType([T.StructField(c, _POST_TYPES[c]) for c in RECORDED_COLUMNS])

# State tables: key and columns. What a table keeps beyond its schema is what the next load needs of it.
STATES: dict[str, tuple[str, T.StructType]] = {
    "media_posts": ("ig_media_id", T.StructType(list(MEDIA_POSTS.fields)).add("recorded", _RECORDED)),
    "media_assets": ("media_id", MEDIA_ASSETS),
    "sync_runs": (
        "id",
        T.StructType(list(SYNC_RUNS.fields)).add("items_landed", "long").add("attempt_pages", ATTEMPT_PAGES)
        .add("pages_unreadable", "long").add("items_invalid", "long").add("last_seen_at", "timestamp").add("last_seq", "long"),
    ),
    "messages": ("message_id", T.StructType().add("message_id", "string").add("hashtag_id", "string").add("delivered_at", "timestamp")),
    "message_counts": ("message_id", T.StructType().add("message_id", "string").add("deliveries", "long")),
}
# Folders of a state, by columns of its rows. Runs lie by day, so that those of long ago are not read with those of today.
_STATE_FOLDERS = {"sync_runs": ["run_day", "bucket"]}
ORDER_WITHIN = {"media_posts": ["hashtag_id", "taken_at", "id"], "media_post_history": ["captured_at"]}


def schema_of(table: str) -> T.StructType:
    return STATES[table][1] if table in STATES else TABLES.get(table) or EXTRA[table]


def conform_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns with the declared types; absent ones become null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def run_day(started_at: Column) -> Column:
    return F.date_format(started_at, "yyyy-MM-dd")


def run_bucket(sync_run_id: Column) -> Column:
    return F.pmod(F.xxhash64(sync_run_id), F.lit(RUN_BUCKETS)).cast("int")


def _bucket(table: str, key: Column) -> Column:
    return run_bucket(key) if table == "sync_runs" else F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _read(spark: SparkSession, schema: T.StructType, base: str, *paths: str) -> DataFrame:
    """Rows below ``base``, or below those of its folders that ``paths`` name; none where nothing is stored yet."""
    try:
        return spark.read.schema(schema).option("basePath", base).parquet(*(paths or [base]))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _by_folder(df: DataFrame, folders: list[str]) -> DataFrame:
    # A folder is written by one task, as one file: its rows are those of one micro-batch, or of one bucket.
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *folders)


def _write_folders(df: DataFrame, table: str, root: str, folders: list[str]) -> None:
    """Write rows that lie in the tasks of their folders."""
    out = df.sortWithinPartitions(*folders, *ORDER_WITHIN.get(table, []))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(f"{root}/{table}")


# -- logs -------------------------------------------------------------------------------------------------------------


def append_log(df: DataFrame, table: str, root: str, load: str, runs: DataFrame | None = None) -> None:
    """Write a load's rows of a log. Tables of runs need ``runs`` (sync_run_id, run_day) to know their folders."""
    schema, folders = schema_of(table), FOLDERS[table]
    if folders is _RUN_FOLDERS:
        days = runs.select("sync_run_id", "run_day")
        df = conform_to(df, schema).join(days, "sync_run_id").withColumn("run_bucket", run_bucket(F.col("sync_run_id")))
    out = df.withColumn("load", F.lit(load))
    out = conform_to(out, T.StructType([*schema.fields, *folders.fields]))
    _write_folders(_by_folder(out, folders.names), table, root, folders.names)


def read_log(spark: SparkSession, table: str, root: str, runs: DataFrame | None = None, load: str | None = None) -> DataFrame:
    """Rows of a log; with ``runs`` (sync_run_id, run_day) those of the named runs, read from their folders only.

    Folders are named to the reader, so neither the rows nor the names of others are listed.
    """
    full = T.StructType([T.StructField(f.name, f.dataType) for f in schema_of(table).fields] + list(FOLDERS[table].fields))
    base, tail = f"{root}/{table}", f"/load={load}" if load else ""
    if runs is None:
        rows = _read(spark, full, base)
        return rows.filter(F.col("load") == load) if load else rows
    if FOLDERS[table] is not _RUN_FOLDERS:
        return _read(spark, full, base, f"{base}{tail}")
    # At most RUN_BUCKETS folders per day on which a run at hand began.
    places = runs.select("run_day", run_bucket(F.col("sync_run_id")).alias("b")).distinct().collect()
    by_day: dict[str, list[int]] = {}
    for day, bucket in places:
        by_day.setdefault(day, []).append(bucket)
    paths = [f"{base}/run_day={day}/run_bucket={{{','.join(map(str, sorted(b)))}}}{tail}" for day, b in sorted(by_day.items())]
    if not paths:
        return spark.createDataFrame([], full)
    return _each(spark, full, base, paths).join(runs.select("sync_run_id"), "sync_run_id", "left_semi")


def _each(spark: SparkSession, schema: T.StructType, base: str, paths: list[str]) -> DataFrame:
    """Folders of several days, of which some may not exist."""
    try:
        return spark.read.schema(schema).option("basePath", base).parquet(*paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    parts = [_read(spark, schema, base, path) for path in paths]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# -- states -----------------------------------------------------------------------------------------------------------


def _state_schema(table: str) -> T.StructType:
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema_of(table).fields])
    folders = _STATE_FOLDERS.get(table, ["bucket"])
    full = T.StructType(list(nullable.fields)).add("load", "string").add("prior", nullable)
    for name in folders:
        full = full.add(name, "string" if name == "run_day" else "integer")
    return full


def state_rows(spark: SparkSession, table: str, root: str) -> DataFrame:
    """All stored rows of a state, with its folders, ``load`` and ``prior``."""
    return _read(spark, _state_schema(table), f"{root}/{table}")


def read_state(spark: SparkSession, table: str, root: str) -> DataFrame:
    """Current rows of a state table."""
    return state_rows(spark, table, root).select(*schema_of(table).names)


def _folders_of(rows: DataFrame, table: str, keys: DataFrame, since: str | None) -> DataFrame:
    """The stored rows in the buckets of ``keys``; BUCKETS numbers at most come to the driver."""
    name = STATES[table][0]
    at_hand = sorted(r[0] for r in keys.select(_bucket(table, F.col(name)).alias("b")).distinct().collect())
    found = rows.filter(F.col("bucket").isin(at_hand)) if at_hand else rows.filter(F.lit(False))
    return found.filter(F.col("run_day") >= since) if since is not None else found


def state_before(spark: SparkSession, table: str, root: str, keys: DataFrame, load: str, since: str | None = None) -> DataFrame:
    """Rows of the given keys as they were before ``load`` began, also when part of it is written already.

    ``keys`` has the table's key column. Only the keys' buckets are read, of runs only those begun ``since`` a day. The
    result is written to the scratch folder: it stays readable while the buckets are replaced.
    """
    name, schema = STATES[table]
    rows = _folders_of(state_rows(spark, table, root), table, keys, since).join(keys.select(name), name, "left_semi")
    now = F.struct(*[F.col(c) for c in schema.names])
    before = rows.select(F.when(F.col("load") == load, F.col("prior")).otherwise(now).alias("row")).filter(F.col("row").isNotNull())
    return staged(before.select("row.*"), f"{table}-before")


def merge_state(changed: DataFrame, table: str, root: str, load: str, since: str | None = None) -> None:
    """Put rows into a state: they replace those of the same key, whose buckets are written anew."""
    spark = changed.sparkSession
    name, schema = STATES[table]
    changed = staged(conform_to(changed, schema), f"{table}-changed")
    folders = _STATE_FOLDERS.get(table, ["bucket"])
    stored = _folders_of(state_rows(spark, table, root), table, changed, since)
    if since is not None:
        # Folders of days on which no run at hand began stay as they are.
        days = [r[0] for r in changed.select(run_day(F.col("started_at"))).distinct().collect()]
        stored = stored.filter(F.col("run_day").isin(days)) if days else stored.filter(F.lit(False))
    # Old and new rows meet in the task that writes their folder: rows move once, not for a join and for the folders again.
    now = F.struct(*[F.col(c) for c in schema.names]).alias("row")
    # Only the rows of this load may be asked for what they were before.
    old = stored.select(now, "load", F.when(F.col("load") == load, F.col("prior")).alias("prior"), *folders, F.lit(1).alias("_age"))
    places = {"bucket": _bucket(table, F.col(name)), "run_day": run_day(F.col("started_at")) if "run_day" in folders else None}
    none = F.lit(None).cast(old.schema["prior"].dataType).alias("prior")
    new = changed.select(now, F.lit(load).alias("load"), none, *[places[f].alias(f) for f in folders], F.lit(0).alias("_age"))
    both = _by_folder(old.unionByName(new), folders)
    same = Window.partitionBy(*folders, F.col(f"row.{name}")).orderBy("_age")
    before = F.lead(F.struct("row", "load", "prior")).over(same).alias("_before")
    newest = both.select("*", F.row_number().over(same).alias("_place"), before).filter(F.col("_place") == 1)
    then = F.when(F.col("_before.load") == load, F.col("_before.prior")).otherwise(F.col("_before.row"))
    out = newest.withColumn("prior", F.when(F.col("_age") == 0, then)).select("row.*", "load", "prior", *folders)
    _write_folders(out, table, root, folders)


# -- lookups ----------------------------------------------------------------------------------------------------------


def point_lookup(table: DataFrame, **keys: object) -> DataFrame:
    """The row with the given unique key."""
    for name, value in keys.items():
        table = table.filter(F.col(name) == F.lit(value))
    return table.limit(1)


def lookup_many(table: DataFrame, key: str, wanted: DataFrame, asked: Column) -> DataFrame:
    """Rows of ``table`` for every asked key, each asked key looked up once."""
    distinct = wanted.select(asked.alias(key)).distinct()
    return table.join(distinct, key)
