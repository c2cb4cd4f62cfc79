"""Column contracts of the raw files, the star schema and the marts."""

from pyspark.sql import DataFrame, functions as F, types as T

# Columns of the raw feed.
RAW_SALES = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "InvoiceNo",
            "StockCode",
            "Description",
            "Quantity",
            "InvoiceDate",
            "UnitPrice",
            "CustomerID",
            "Country",
        )
    ]
)

RAW_FAMILIES = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("item_family", "item_family_description", "category")]
)

PRICE = T.DecimalType(18, 4)
MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(28, 2)

FLAGS = [
    "is_operational_item",
    "is_unknown_item",
    "is_special_item",
    "is_modification_item",
    "is_error_item",
]


def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


_INT, _LONG, _TEXT, _DAY, _YES = T.IntegerType(), T.LongType(), T.StringType(), T.DateType(), T.BooleanType()
_WALL_CLOCK = T.TimestampNTZType()

# Columns of the tables.
TABLES: dict[str, T.StructType] = {
    "stg_transactions": _struct(
        invoice_id=_TEXT,
        item_id=_TEXT,
        item_description=_TEXT,
        quantity_amount=_INT,
        unit_price_eur=PRICE,
        customer_id=_INT,
        country_name=_TEXT,
        raw_invoice_date=_TEXT,
        event_timestamp_invoiced_at=_WALL_CLOCK,
        transaction_id=_LONG,
        item_uuid=_TEXT,
        date=_DAY,
    ),
    "dim_item_family": _struct(item_family_id=_INT, item_family_description=_TEXT, item_category=_TEXT),
    "dim_date": _struct(
        date=_DAY, date_id=_INT, year=_INT, month=_INT, day=_INT, day_of_week=_TEXT, is_weekend=_YES
    ),
    "dim_location": _struct(
        country_id=_INT, iso_country_code=_TEXT, country_name=_TEXT, country_code_name=_TEXT
    ),
    "dim_items": _struct(
        item_uuid=_TEXT,
        item_id=_TEXT,
        item_family_id=_INT,
        item_description=_TEXT,
        item_variant=_TEXT,
        **{flag: _YES for flag in FLAGS},
    ),
    "dim_customers": _struct(customer_id=_INT, customer_name=_TEXT),
    "fact_transactions": _struct(
        transaction_id=_LONG,
        invoice_id=_TEXT,
        event_timestamp_invoiced_at=_WALL_CLOCK,
        date_id=_INT,
        item_uuid=_TEXT,
        item_id=_TEXT,
        quantity_amount=_INT,
        unit_price_eur=PRICE,
        total_price_eur=MONEY,
        customer_id=_INT,
        country_id=_INT,
    ),
}


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns as strings, the form a CSV is read in."""
    return T.StructType([T.StructField(field.name, T.StringType()) for field in schema])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name, cast to its types; a bad value raises."""
    return df.select([F.col(field.name).cast(field.dataType).alias(field.name) for field in schema])


def as_published(df: DataFrame) -> DataFrame:
    """Money columns as double, the type consumers of the marts see."""
    return df.select(
        [
            F.col(field.name).cast("double").alias(field.name)
            if isinstance(field.dataType, T.DecimalType)
            else F.col(field.name)
            for field in df.schema
        ]
    )
