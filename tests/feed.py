"""Small hand-made feeds."""

from tillmart.schemas import RAW_FAMILIES, RAW_SALES

DEFAULTS = {
    "InvoiceNo": "536365",
    "StockCode": "85123A",
    "Description": "WHITE HANGING HEART",
    "Quantity": "6",
    "InvoiceDate": "12/1/10 8:26",
    "UnitPrice": "2.55",
    "CustomerID": "17850",
    "Country": "United Kingdom",
}


def sales(spark, *rows: dict):
    return spark.createDataFrame([tuple({**DEFAULTS, **row}.values()) for row in rows], RAW_SALES)


def families(spark, *rows: tuple):
    return spark.createDataFrame(list(rows), RAW_FAMILIES)
