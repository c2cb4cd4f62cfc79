"""Figures for the sales, customer and product pages."""

from pyspark.sql import DataFrame, functions as F


def _month():
    return F.trunc("date", "month").alias("month")


def sales_monthly(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy(_month(), "country_name").agg(
        F.sum("total_price_eur").alias("total_sales_amount"),
        F.countDistinct("invoice_id").alias("total_invoices"),
        F.count_if("is_return").alias("total_returns"),
    )


def customer_overview(customers: DataFrame) -> DataFrame:
    return customers.groupBy("country_name", "favorite_category").agg(
        F.count("customer_id").alias("total_customers"),
        F.sum("total_sales_amount").alias("total_sales_amount"),
        F.sum("total_invoices").alias("total_invoices"),
        F.sum("total_returns").alias("total_returns"),
    )


def category_monthly(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy(_month(), "item_category").agg(
        F.sum("total_price_eur").alias("total_sales_amount"),
        F.sum("quantity_amount").alias("total_quantity"),
        F.countDistinct("customer_id").alias("total_customers"),
    )


#: Registers of a sketch are 2 ** SKETCH_BITS; an estimate is off by more than ``SKETCH_ERROR`` in three of a thousand cases at most.
SKETCH_BITS = 12
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def monthly_sketches(transactions: DataFrame) -> DataFrame:
    """Sums and an invoice sketch per month and country: what ``sales_between`` needs in place of the transactions."""
    return transactions.groupBy(_month(), "country_name").agg(
        F.sum("total_price_eur").alias("total_sales_amount"),
        F.hll_sketch_agg("invoice_id", F.lit(SKETCH_BITS)).alias("invoices_sketch"),
    )


def sales_between(sketches: DataFrame, first: str, last: str) -> DataFrame:
    """Sales and about how many invoices per country, over the months from ``first`` to ``last``; an invoice of two months counts once."""
    months = sketches.filter(F.col("month").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return months.groupBy("country_name").agg(
        F.sum("total_sales_amount").alias("total_sales_amount"),
        F.hll_sketch_estimate(F.hll_union_agg("invoices_sketch")).alias("estimated_invoices"),
    )


def quarter_sales(monthly: DataFrame, dates: DataFrame, year: int, quarter: int) -> DataFrame:
    """Sales per month and weekday of a quarter, from a fact laid out by month.

    The calendar is filtered, not the fact: the join's keys are the fact's folders, so the planner reads those of the days that are left.
    """
    days = dates.filter((F.col("year") == year) & (F.quarter("date") == quarter)).select("year", "month", "date_id", "day_of_week")
    return (
        monthly.join(days, ["year", "month", "date_id"])
        .groupBy("year", "month", "day_of_week")
        .agg(F.sum("total_price_eur").alias("total_sales_amount"), F.count("*").alias("n_lines"))
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    counts = None
    for name, df in tables.items():
        size = df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        counts = size if counts is None else counts.unionByName(size)
    return counts


def table_sums(tables: dict[str, DataFrame], summed: dict[str, str]) -> DataFrame:
    """Rows of each table and the sum of one of its columns."""
    sums = None
    for name, column in summed.items():
        size = tables[name].agg(F.count("*").alias("n_rows"), F.sum(F.col(column).cast("decimal(28,2)")).cast("double").alias("total"))
        size = size.select(F.lit(name).alias("table_name"), "n_rows", "total")
        sums = size if sums is None else sums.unionByName(size)
    return sums
