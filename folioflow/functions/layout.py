"""Reading order of text blocks on a page, as windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.text import strip
from folioflow.thresholds import DEFAULT, Thresholds

PAGE = ["paper_id", "page_number"]


def reading_order(blocks: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """Add ``position`` (1, 2, ...) to the text blocks of each page that are not blank.

    With two columns of at least two blocks, wide blocks cut the page into regions; in each the left
    column comes before the right one. Otherwise blocks go from top to bottom. A window spans one page.
    """
    kept = blocks.where("block_type = 0").where(strip(F.col("text")) != "")
    wide = (F.col("x1") - F.col("x0")) >= F.col("page_width") * t.wide_block
    right = (F.col("x0") + F.col("x1")) / 2 >= F.col("page_width") / 2
    page = Window.partitionBy(*PAGE)
    sided = kept.withColumn("wide", wide).withColumn("side", F.when(wide, 0).when(right, 1).otherwise(0))
    sided = sided.withColumn("two", (F.count_if(~F.col("wide") & (F.col("side") == 0)).over(page) >= 2) & (F.count_if(~F.col("wide") & (F.col("side") == 1)).over(page) >= 2))
    above = F.sum(F.col("wide").cast("int")).over(page.orderBy("y0").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    nth = F.row_number().over(Window.partitionBy(*PAGE, "wide").orderBy("y0", "x0", "block_no")) - 1
    region = F.when(~F.col("two"), 0).when(F.col("wide"), nth).otherwise(above)
    placed = sided.withColumn("region", region).withColumn("last", F.col("two") & F.col("wide")).withColumn("column", F.when(F.col("two"), F.col("side")).otherwise(0))
    order = Window.partitionBy(*PAGE).orderBy("region", "last", "column", "y0", "x0", "block_no")
    return placed.withColumn("position", F.row_number().over(order)).drop("wide", "side", "two", "region", "last", "column")


def layout_text(blocks: DataFrame, t: Thresholds = DEFAULT) -> DataFrame:
    """(paper_id, page_number, raw_text): the blocks of a page in reading order, a blank line between."""
    ordered = reading_order(blocks, t)
    parts = F.array_sort(F.collect_list(F.struct("position", strip(F.col("text")).alias("text"))))
    return ordered.groupBy(*PAGE).agg(F.array_join(F.transform(parts, lambda p: p.text), "\n\n").alias("raw_text"))
