"""Rejected records and values of a feed as rows of their own, with reason, text and place."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillmart.functions import columns as fn
from tillmart.sources.files import MALFORMED

#: How each column that can be unreadable is read.
READERS = {
    "Quantity": ("rejected_quantity", fn.lenient_int),
    "UnitPrice": ("rejected_price", fn.lenient_price),
    "CustomerID": ("rejected_customer", fn.lenient_int),
    "InvoiceDate": ("rejected_date", fn.wall_clock),
}
PLACE = "place"


def with_place(lines: DataFrame) -> DataFrame:
    """Records of files with their file and the first byte of the block they were read from."""
    return lines.withColumn(PLACE, F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block_start")))


def _rejections(good: Column) -> Column:
    """All that is rejected of a record, as an array; empty for a record that is read whole."""
    found = [F.when(~good, F.struct(F.lit("malformed_line").alias("reason"), F.col(MALFORMED).alias("text")))]
    for column, (reason, read) in READERS.items():
        value = F.col(column)
        found.append(F.when(good & value.isNotNull() & read(value).isNull(), F.struct(F.lit(reason).alias("reason"), value.alias("text"))))
    return F.filter(F.array(*found), lambda rejection: rejection.isNotNull())


def rejected(lines: DataFrame) -> DataFrame:
    """(reason, invoice_id, item_id, text, and ``PLACE`` if ``lines`` has it): a row for each malformed record, with its whole
    text, and for each value that could not be read, with the value; a record with two such values has two rows.

    The values' records are loaded with NULL in place of them, malformed records are not loaded.
    """
    good = F.col(MALFORMED).isNull()
    place = [PLACE] if PLACE in lines.columns else []
    each = lines.select(
        F.when(good, F.col("InvoiceNo")).alias("invoice_id"),
        F.when(good, F.col("StockCode")).alias("item_id"),
        *place,
        F.explode(_rejections(good)).alias("rejection"),
    )
    return each.select("rejection.reason", "invoice_id", "item_id", "rejection.text", *place)


def balance(lines: DataFrame, staged: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Records of the feed, those loaded and those kept out, and whether they add up."""
    counts = [
        lines.agg(F.count(F.coalesce(F.col(lines.columns[0]), F.col(MALFORMED), F.lit(""))).alias("n_records")),
        staged.agg(F.count("*").alias("n_loaded")),
        quarantine.agg(F.count_if(F.col("reason") == "malformed_line").alias("n_quarantined")),
    ]
    # three rows with a count each, made one
    names = [count.columns[0] for count in counts]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts)
    row = rows.agg(*[F.coalesce(F.max(name), F.lit(0)).alias(name) for name in names])
    return row.withColumn("adds_up", F.col("n_records") == F.col("n_loaded") + F.col("n_quarantined"))
