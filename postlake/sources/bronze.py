"""The append-only raw layer: page responses to one row per item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.functions.scalars import stable_id, usage_summary
from postlake.schemas import DATA_POINTS, LANDED_PAGE, PAGE_BODY


def with_page_items(pages: DataFrame) -> DataFrame:
    """Add ``page`` (parsed body) and ``items`` (JSON text per item; null for a body that is
    not a page). Pages that have been through ``parsed_pages`` stay as they are."""
    if "items" in pages.columns:
        return pages
    return pages.withColumn("page", F.from_json("body", PAGE_BODY)).withColumn("items", F.col("page.data"))


def parsed_pages(pages: DataFrame) -> DataFrame:
    """Pages parsed once, to be stored before several readers: items and paging in place of the body, which only pages that
    are none keep."""
    parsed = with_page_items(pages).withColumn("page", F.struct("page.paging"))
    return parsed.withColumn("body", F.when(F.col("items").isNull(), F.col("body")))


def land_pages(pages: DataFrame, positions: DataFrame | None = None) -> DataFrame:
    """One ``data_points`` row per item, positions counted from 0.

    ``page_number`` restarts with every attempt of a run, ``position_overall`` continues.
    ``positions`` (sync_run_id, items_landed, attempt_pages) continues runs of earlier loads. The windows range over the pages
    of one run, which the item cap bounds; items are exploded after them.
    """
    parsed = with_page_items(pages).filter(F.col("items").isNotNull())
    arrived = Window.partitionBy("sync_run_id").orderBy("arrival_seq")
    attempts = Window.partitionBy("sync_run_id", "attempt").orderBy("arrival_seq")
    before = F.coalesce(F.sum(F.size("items")).over(arrived.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = parsed.withColumns({"_offset": before, "page_number": F.row_number().over(attempts)})
    if positions is not None:
        landed = positions.select("sync_run_id", "items_landed", F.map_from_entries("attempt_pages").alias("_pages"))
        earlier = F.coalesce(F.try_element_at("_pages", F.col("attempt")), F.lit(0))
        placed = placed.join(landed, "sync_run_id", "left").withColumns(
            {
                "_offset": F.col("_offset") + F.coalesce("items_landed", F.lit(0)),
                "page_number": F.col("page_number") + earlier,
            }
        )
    items = placed.select("*", F.posexplode("items").alias("position_in_page", "payload"))
    position = F.col("_offset") + F.col("position_in_page")
    columns = {
        "id": stable_id(F.col("sync_run_id"), position.cast("string")),
        "ig_media_id": F.get_json_object("payload", "$.id"),
        "position_overall": position,
    }
    return items.select(
        *[columns.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in DATA_POINTS.fields]
    )


def unreadable_pages(pages: DataFrame) -> DataFrame:
    """Pages whose body is no page, as they arrived, with the reason. With ``land_pages`` they make up all pages."""
    broken = with_page_items(pages).filter(F.col("items").isNull())
    reason = F.when(F.try_parse_json("body").isNull(), "not JSON").otherwise("no data array")
    return broken.select(*[c for c in pages.columns if c not in ("page", "items")], reason.alias("reason"))


def page_heads(pages: DataFrame) -> DataFrame:
    """What runs need to know of their pages, without the bodies: number of items (null where the body is no page),
    the cursor of the next page and the usage reading."""
    usage = usage_summary(F.col("app_usage"), F.col("business_usage"))
    return with_page_items(pages).select(
        "sync_run_id", "hashtag_id", "source", "attempt", "arrival_seq", "fetched_at", F.size("items").alias("items"),
        F.when(F.col("page.paging.next").isNotNull(), F.col("page.paging.cursors.after")).alias("next_cursor"),
        F.col("page.paging.next").isNotNull().alias("goes_on"), F.to_json(usage).alias("usage"),
    ).withColumn("items", F.when(F.col("items") >= 0, F.col("items")))


def raw_run_scan(data_points: DataFrame, sync_run_id: str | Column) -> DataFrame:
    """Raw rows of one run in response order."""
    return data_points.filter(F.col("sync_run_id") == sync_run_id).orderBy("position_overall")


def raw_count_by_run(data_points: DataFrame) -> DataFrame:
    return data_points.groupBy("sync_run_id").agg(F.count("*").alias("items"))


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDED_PAGE).json(path)


def read_landing_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Pages as they arrive in a landing folder; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(LANDED_PAGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)
