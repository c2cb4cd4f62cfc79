"""Each checked query as SQL for DuckDB, written apart from the Spark plans."""

from tillmart.functions.places import COUNTRY_LOCALES, DEFAULT_LOCALE, LOCATIONS, NAMES
from tillmart.functions.vocabulary import (
    ADDED_TEXTS,
    CATEGORY_RULES,
    CLASS_KEYWORDS,
    FLAG_TEXTS,
    OTHER_CATEGORY,
)
from tillmart.sources.order_tables import ODD_DESCRIPTIONS, feed_country


def _text(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def _texts(values) -> str:
    return ", ".join(_text(value) for value in values)


def _in_texts(flag: str) -> str:
    return f"coalesce(item_description IN ({_texts(FLAG_TEXTS[flag])}), false) AS {flag}"


_ODD = " ".join(f"WHEN l_partkey % {divisor} = 0 THEN {_text(odd)}" for divisor, odd in ODD_DESCRIPTIONS)
_NATIONS = ", ".join(f"({k}, {_text(feed_country(k, ''))})" for k in range(25) if k % 5 != 4)
_PLACES = ", ".join(
    f"({number}, {_text(iso)}, {_text(name)}, {_text(code)})" for number, iso, name, code in LOCATIONS
)
_POOL = ", ".join(
    f"({_text(country)}, [{_texts(NAMES[locale[:2]][0])}], [{_texts(NAMES[locale[:2]][1])}])"
    for country, locale in COUNTRY_LOCALES.items()
)
_LOCALES = ", ".join(f"({_text(country)}, {_text(locale)})" for country, locale in COUNTRY_LOCALES.items())
_CLASSES = " ".join(
    "WHEN " + " OR ".join(f"contains(lower(item_description), {_text(word)})" for word in words) + f" THEN {_text(name)}"
    for name, words in CLASS_KEYWORDS.items()
)
_ADDED = ", ".join(f"({_text(name)}, {_text(text)})" for name, texts in ADDED_TEXTS.items() for text in texts)
_RULES = ", ".join(
    f"({number}, {_text(word)}, {_text(category)})" for number, (word, category) in enumerate(CATEGORY_RULES, 1)
)
# A record with a quoted line break is two lines.
_TORN = "l_orderkey % 229 = 0 AND l_linenumber = 2"


def _int(column: str) -> str:
    """Whole part of a plain number."""
    whole = f"try_cast(split_part({column}, '.', 1) AS INT)"
    return f"CASE WHEN regexp_full_match({column}, '[+-]?[0-9]+([.][0-9]*)?') THEN {whole} END"


_FLAGS = "is_operational_item, is_unknown_item, is_special_item, is_modification_item, is_error_item"
_NO_FLAG = "NOT (is_operational_item OR is_unknown_item OR is_special_item OR is_modification_item OR is_error_item)"

_FEED = f"""
nations AS (SELECT * FROM (VALUES {_NATIONS}) AS v(nation_key, name)),
lines AS (
  SELECT *,
    o_orderdate + INTERVAL 14 YEAR + to_minutes((l_orderkey * 7) % 1440)
      + to_days(CASE WHEN l_orderkey % 5 = 0 AND l_linenumber = 7 THEN 1 ELSE 0 END) AS moment
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN nations ON n_nationkey = nation_key),
raw AS (
  SELECT
    CAST(l_orderkey AS VARCHAR) AS InvoiceNo,
    CASE WHEN l_partkey % 97 = 0 THEN 'POST' WHEN l_partkey % 89 = 0 THEN 'gift_0001_20'
      ELSE CAST(10000 + l_partkey // 4 AS VARCHAR) || ['', 'A', 'B', 'bl'][CAST(l_partkey % 4 AS INT) + 1]
    END AS StockCode,
    CASE {_ODD}
      WHEN l_linenumber = 7 THEN upper(p_name) || ' LARGE EDITION'
      WHEN l_linenumber = 6 THEN 'new ' || lower(p_name)
      WHEN l_linenumber = 5 AND l_partkey % 3 = 0 THEN 'MINI'
      ELSE upper(p_name) END AS Description,
    CASE WHEN l_orderkey % 211 = 0 THEN 'n/a' WHEN l_orderkey % 233 = 0 THEN NULL
      ELSE CAST(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * CAST(l_quantity AS INT) AS VARCHAR)
        || CASE WHEN l_orderkey % 251 = 0 THEN '.75' ELSE '' END
    END AS Quantity,
    CASE WHEN l_orderkey % 199 = 0 THEN 'unknown' WHEN l_orderkey % 241 = 0 THEN NULL
      WHEN l_orderkey % 193 = 0 THEN strftime(moment, '%-m/%-d/%Y %-H:%M')
      ELSE strftime(moment, '%-m/%-d/%y %-H:%M') END AS InvoiceDate,
    CASE WHEN l_orderkey % 223 = 0 THEN 'free' WHEN l_orderkey % 239 = 0 THEN NULL
      ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END AS UnitPrice,
    CASE WHEN l_orderkey % 10 = 0 THEN NULL
      WHEN l_orderkey % 101 = 0 THEN 'x'
      WHEN l_orderkey % 107 = 0 THEN '1e3'
      WHEN l_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) || '.0'
      ELSE CAST(o_custkey AS VARCHAR) END AS CustomerID,
    CASE WHEN l_orderkey % 17 = 0 THEN 'EIRE' ELSE coalesce(name, n_name) END AS Country
  FROM lines WHERE NOT (l_orderkey % 229 = 0 AND l_linenumber = 2)),
stg AS (
  SELECT row_number() OVER () AS id,
    InvoiceNo AS invoice_id, StockCode AS item_id, Description AS item_description,
    {_int("Quantity")} AS quantity_amount,
    try_cast(UnitPrice AS DECIMAL(18,4)) AS unit_price,
    {_int("CustomerID")} AS customer_id,
    Country AS country_name, InvoiceDate AS raw_invoice_date,
    try_strptime(InvoiceDate, '%m/%d/%y %H:%M') AS event_timestamp_invoiced_at,
    sha256(concat_ws('_', StockCode, Description)) AS item_uuid,
    CAST(try_strptime(InvoiceDate, '%m/%d/%y %H:%M') AS DATE) AS date
  FROM raw),
families AS (
  SELECT CAST(10000 + p_partkey // 4 AS INT) AS item_family_id,
    min(upper(p_name)) AS item_family_description, min(p_type) AS item_category
  FROM part WHERE (10000 + p_partkey // 4) % 7 <> 0 GROUP BY ALL),
places AS (
  SELECT * FROM (VALUES {_PLACES}) AS v(country_id, iso_country_code, country_name, country_code_name)),
items AS (
  SELECT item_uuid, item_id,
    try_cast(nullif(regexp_extract(item_id, '^([0-9]+)', 1), '') AS INT) AS item_family_id,
    item_description,
    CASE WHEN regexp_full_match(item_id, '[0-9]+') THEN NULL
      ELSE regexp_extract(item_id, '([A-Za-z]+)$', 1) END AS item_variant,
    length(item_id) < 5 OR regexp_matches(item_id, '(?i)gift') AS is_operational_item,
    {_in_texts('is_unknown_item')}, {_in_texts('is_special_item')},
    {_in_texts('is_modification_item')}, {_in_texts('is_error_item')}
  FROM (SELECT DISTINCT item_uuid, item_id, item_description FROM stg)),
fact AS (
  SELECT stg.* EXCLUDE (country_name, date),
    CASE WHEN date BETWEEN DATE '2009-01-01' AND DATE '2025-12-31'
      THEN CAST(date_diff('day', DATE '2009-01-01', date) + 1 AS INT) END AS date_id,
    CAST(round(quantity_amount * unit_price, 2) AS DECIMAL(18,2)) AS total, country_id
  FROM stg LEFT JOIN places USING (country_name)),
sold AS (
  SELECT f.id, f.invoice_id, f.item_uuid, i.item_id, i.item_description, i.item_family_id,
    c.item_family_description, c.item_category, i.item_variant, {_FLAGS},
    CAST(round(f.unit_price, 2) AS DECIMAL(18,2)) AS price, f.total, f.quantity_amount, f.customer_id,
    p.country_id, p.country_name, f.date_id, f.event_timestamp_invoiced_at AS moment,
    CAST(DATE '2009-01-01' + (f.date_id - 1) AS DATE) AS date,
    dayname(DATE '2009-01-01' + (f.date_id - 1)) AS day_of_week,
    coalesce({_NO_FLAG} AND (f.quantity_amount < 0 OR f.total < 0), false) AS is_return
  FROM fact f
  LEFT JOIN items i ON f.item_uuid = i.item_uuid
  LEFT JOIN families c ON i.item_family_id = c.item_family_id
  LEFT JOIN places p ON f.country_id = p.country_id)"""

_STAGED = """SELECT invoice_id, item_id, item_description, quantity_amount,
  CAST(unit_price AS DOUBLE) AS unit_price_eur, customer_id, country_name, raw_invoice_date,
  event_timestamp_invoiced_at, item_uuid, date FROM stg"""

_FACT = """SELECT invoice_id, event_timestamp_invoiced_at, date_id, item_uuid, item_id, quantity_amount,
  CAST(unit_price AS DOUBLE) AS unit_price_eur, CAST(total AS DOUBLE) AS total_price_eur,
  customer_id, country_id FROM fact"""

_ITEM_MART = f"""SELECT item_uuid, item_description, item_family_id, item_family_description, item_category,
  {_FLAGS}, CAST(sum(total) AS DOUBLE) AS total_sales_amount,
  count(DISTINCT customer_id) AS total_customers, CAST(sum(quantity_amount) AS BIGINT) AS total_quantity,
  count(DISTINCT id) AS total_transactions
FROM sold WHERE item_family_description IS NOT NULL
GROUP BY item_uuid, item_description, item_family_id, item_family_description, item_category, {_FLAGS}"""

_INVOICE_MEASURES = """CAST(sum(total) AS DOUBLE) AS total_invoice_amount,
  CAST(sum(quantity_amount) AS BIGINT) AS total_quantity, count(DISTINCT item_uuid) AS total_items"""

_HAS = [
    f"bool_or(is_{name}) AS has_{name}"
    for name in ("return", "operational_item", "unknown_item", "special_item", "modification_item", "error_item")
]

_INVOICE_MART = f"""SELECT invoice_id, date_id, date, customer_id, country_name, day_of_week, country_id,
  {_INVOICE_MEASURES}, {', '.join(_HAS)}
FROM sold GROUP BY invoice_id, date_id, date, customer_id, country_name, day_of_week, country_id"""


def _earliest(column: str, key: str) -> str:
    """Value of the first line with a known key; of lines at the same time that with the smallest key."""
    return f"first({column} ORDER BY moment ASC NULLS LAST, {key}) FILTER ({key} IS NOT NULL) AS {column}"


_CUSTOMER_MEASURES = """CAST(sum(total) AS DOUBLE) AS total_sales_amount,
  CAST(sum(quantity_amount) AS BIGINT) AS total_quantity, count(DISTINCT id) AS total_transactions,
  count(DISTINCT invoice_id) AS total_invoices, count(*) FILTER (is_return) AS total_returns,
  CAST(CAST(sum(total) * 100 AS BIGINT) AS HUGEINT) AS cents"""

# Half of a cent away from zero, in whole numbers.
_AVERAGE = """CAST(sign(cents) * ((2 * abs(cents) + total_transactions) // (2 * total_transactions)) AS DOUBLE)
  / 100.0 AS avg_sales_per_transaction"""

_FAVORITES = """favorites AS (
  SELECT customer_id, item_category, count(*) AS category_count,
    CAST(row_number() OVER (PARTITION BY customer_id
      ORDER BY count(*) DESC, item_category ASC NULLS LAST) AS INT) AS category_rank
  FROM sold GROUP BY customer_id, item_category QUALIFY category_rank = 1)"""

_CUSTOMERS = f"""{_FAVORITES},
customer_totals AS (
  SELECT customer_id, country_name, {_CUSTOMER_MEASURES} FROM sold GROUP BY customer_id, country_name),
customer_mart AS (
  SELECT t.customer_id, country_name, total_sales_amount, total_quantity, total_transactions, total_invoices,
    total_returns, item_category AS favorite_category, {_AVERAGE}
  FROM customer_totals t LEFT JOIN favorites f ON t.customer_id = f.customer_id)"""

_FIRST_COUNTRY = """first_country AS (
  SELECT customer_id, country_name, event_timestamp_invoiced_at AS first_seen FROM stg
  WHERE customer_id IS NOT NULL AND country_name IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY customer_id
    ORDER BY event_timestamp_invoiced_at ASC NULLS LAST, country_name) = 1)"""

_DIM_CUSTOMERS = f"""{_FIRST_COUNTRY},
pool AS (
  SELECT country_name, idx, first[idx % 6 + 1] || ' ' || last[idx // 6 % 5 + 1] AS customer_name
  FROM (VALUES {_POOL}) AS v(country_name, first, last), range(30) AS r(idx)),
customers AS (
  SELECT customer_id, coalesce(customer_name, 'Unknown') AS customer_name
  FROM first_country c LEFT JOIN pool p
    ON c.country_name = p.country_name AND (CAST(customer_id AS BIGINT) * 2654435761 + 17) % 30 = idx)"""

_WEIRD = f"""ordered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id
    ORDER BY description_len DESC, item_description) AS INT) AS description_order
  FROM (SELECT item_id, item_description,
      upper(item_description) = item_description AND lower(item_description) <> item_description AS is_all_uppercase,
      CAST(length(item_description) AS INT) AS description_len
    FROM (SELECT item_id, coalesce(item_description, 'nan') AS item_description
      FROM items WHERE NOT is_operational_item))),
weird AS (
  SELECT * FROM ordered
  WHERE (description_order > 1 AND description_len < 13) OR NOT is_all_uppercase),
classes AS (
  SELECT item_description, CASE {_CLASSES} END AS item_class
  FROM (SELECT DISTINCT item_description FROM weird)),
known AS (
  SELECT item_class, item_description FROM classes WHERE item_class IS NOT NULL
  UNION SELECT * FROM (VALUES {_ADDED}) AS v(item_class, item_description))"""

_WORDS = f"""plain AS (
  SELECT item_family_id, item_description, item_uuid, item_id FROM items
  WHERE {_NO_FLAG} AND item_family_id IS NOT NULL AND item_description IS NOT NULL),
word_counts AS (
  SELECT item_family_id, word, count(*) AS n
  FROM (SELECT item_family_id, unnest(string_split_regex(item_description, '\\s+')) AS word FROM plain)
  WHERE word <> '' GROUP BY item_family_id, word),
top_words AS (
  SELECT item_family_id, word FROM word_counts
  QUALIFY n = max(n) OVER (PARTITION BY item_family_id))"""

_SORTED_MONTH = "CAST(date_trunc('month', date) AS DATE) AS month"


def _check(name: str, condition: str, table: str) -> str:
    return f"SELECT {_text(name)} AS check_name, count(*) FILTER ({condition}) AS n_rows FROM {table}"


_QUALITY = " UNION ALL ".join(
    [
        f"SELECT 'feed_lines' AS check_name, count(*) + count(*) FILTER ({_TORN}) AS n_rows FROM lines",
        f"SELECT 'malformed_lines' AS check_name, 2 * count(*) FILTER ({_TORN}) AS n_rows FROM lines",
        _check("rejected_quantity", f"Quantity IS NOT NULL AND {_int('Quantity')} IS NULL", "raw"),
        _check("rejected_price", "UnitPrice IS NOT NULL AND try_cast(UnitPrice AS DECIMAL(18,4)) IS NULL", "raw"),
        _check("rejected_customer", f"CustomerID IS NOT NULL AND {_int('CustomerID')} IS NULL", "raw"),
        _check(
            "rejected_date",
            "InvoiceDate IS NOT NULL AND try_strptime(InvoiceDate, '%m/%d/%y %H:%M') IS NULL",
            "raw",
        ),
        _check("missing_description", "Description IS NULL", "raw"),
        _check("missing_customer", "CustomerID IS NULL", "raw"),
        _check("missing_quantity", "Quantity IS NULL", "raw"),
        _check("missing_price", "UnitPrice IS NULL", "raw"),
        _check("missing_date", "InvoiceDate IS NULL", "raw"),
        _check("fact_without_time", "event_timestamp_invoiced_at IS NULL", "fact"),
        _check("fact_outside_calendar", "event_timestamp_invoiced_at IS NOT NULL AND date_id IS NULL", "fact"),
        _check("fact_without_country", "country_id IS NULL", "fact"),
        _check(
            "fact_total_too_large",
            "quantity_amount IS NOT NULL AND unit_price IS NOT NULL AND total IS NULL",
            "fact",
        ),
    ]
    + [
        "SELECT 'fact_without_item' AS check_name, count(*) AS n_rows FROM fact f"
        " WHERE NOT EXISTS (SELECT 1 FROM items i WHERE i.item_uuid = f.item_uuid)",
        "SELECT 'items_without_family' AS check_name, count(*) AS n_rows FROM items i"
        " WHERE NOT EXISTS (SELECT 1 FROM families f WHERE f.item_family_id = i.item_family_id)"
    ]
    + [
        f"SELECT 'repeated_{key}' AS check_name, count(*) AS n_rows"
        f" FROM (SELECT {key} FROM {table} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)"
        for key, table in (
            ("item_uuid", "items"),
            ("item_family_id", "families"),
            ("country_id", "places"),
            ("country_name", "places"),
        )
    ]
    + [f"SELECT 'repeated_{key}' AS check_name, CAST(0 AS BIGINT) AS n_rows" for key in ("date_id", "date")]
)


_DATES = """dates AS (
  SELECT date, CAST(date_diff('day', DATE '2009-01-01', date) + 1 AS INT) AS date_id, CAST(year(date) AS INT) AS year,
    CAST(month(date) AS INT) AS month, CAST(day(date) AS INT) AS day, dayname(date) AS day_of_week,
    dayofweek(date) IN (0, 6) AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(DATE '2009-01-01', DATE '2025-12-31', INTERVAL 1 DAY)) AS DATE) AS date))"""

# Table, summed column, columns.
_SUMS = {
    "stg_transactions": ("stg", "quantity_amount", 12),
    "dim_customers": ("customers", "customer_id", 2),
    "dim_date": ("dates", "date_id", 7),
    "dim_item_family": ("families", "item_family_id", 3),
    "dim_items": ("items", "item_family_id", 10),
    "dim_location": ("places", "country_id", 4),
    "fact_transactions": ("fact", "total", 11),
    "int_items": (f"({_ITEM_MART})", "total_sales_amount", 14),
    "int_transactions": ("sold", "total", 23),
    "int_invoices": (f"({_INVOICE_MART})", "total_invoice_amount", 16),
    "int_customers": ("customer_mart", "total_sales_amount", 9),
}


def _sums(names: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{shown}' AS table_name, count(*) AS n_rows,"
        f" CAST(sum(CAST({_SUMS[name][1]} AS DECIMAL(28,2))) AS DOUBLE) AS total FROM {_SUMS[name][0]}"
        for shown, name in names.items()
    )


def _draw(*columns: str) -> str:
    values = ", ".join(f"coalesce(CAST({column} AS VARCHAR), '<null>')" for column in columns)
    return f"md5(concat_ws('|', '7', {values}))"


def _with(*parts: str) -> str:
    *tables, query = parts
    return "WITH " + ",\n".join([_FEED, *tables]) + "\n" + query


def oracle_sql() -> dict[str, str]:
    items = f"""SELECT item_uuid, item_id, item_family_id, item_description, item_variant, {_FLAGS} FROM items"""
    other_flags = ("is_unknown_item", "is_special_item", "is_modification_item", "is_error_item")
    any_other = "(NOT is_operational_item AND (" + " OR ".join(other_flags) + "))"
    checked = {
        "csv_scan": _with("SELECT * FROM raw"),
        "csv_roundtrip": _with("SELECT * FROM families"),
        "parquet_scan": "SELECT * FROM lineitem",
        "parquet_roundtrip": _with(items),
        "partition_overwrite": _with(
            _FACT.replace(
                "country_id FROM fact",
                "country_id, CAST(year(event_timestamp_invoiced_at) AS INT) AS year,"
                " CAST(month(event_timestamp_invoiced_at) AS INT) AS month FROM fact",
            )
        ),
        "typed_load": _with(_FACT),
        "ctas_replace": _with(_ITEM_MART),
        "publish_marts": _with(_INVOICE_MART),
        "incremental_load": _with(_STAGED),
        "stg_transactions": _with(_STAGED),
        "dim_item_family": _with("SELECT * FROM families"),
        "dim_date": _with(
            _DATES,
            """SELECT dates.*, coalesce(n_lines, 0) AS n_lines FROM dates
LEFT JOIN (SELECT date, count(*) AS n_lines FROM stg GROUP BY date) USING (date)""",
        ),
        "dim_location": _with(
            """SELECT places.*, coalesce(n_lines, 0) AS n_lines FROM places
LEFT JOIN (SELECT country_name, count(*) AS n_lines FROM stg GROUP BY country_name) USING (country_name)"""
        ),
        "dim_items": _with(items),
        "dim_customers": _with(_DIM_CUSTOMERS, "SELECT * FROM customers"),
        "fact_transactions": _with(_FACT),
        "int_items": _with(_ITEM_MART),
        "int_transactions": _with(
            f"""SELECT invoice_id, item_uuid, item_id, item_description, item_family_description, item_category,
  item_variant, {_FLAGS}, CAST(price AS DOUBLE) AS unit_price_eur, CAST(total AS DOUBLE) AS total_price_eur,
  quantity_amount, customer_id, country_id, country_name, date_id, date, day_of_week, is_return FROM sold"""
        ),
        "int_invoices": _with(_INVOICE_MART),
        "int_customers": _with(_CUSTOMERS, "SELECT * FROM customer_mart"),
        "invoice_first": _with(
            f"""SELECT invoice_id, {', '.join(_earliest(column, key) for column, key in (
      ('date_id', 'date_id'), ('date', 'date_id'), ('day_of_week', 'date_id'), ('customer_id', 'customer_id'),
      ('country_id', 'country_id'), ('country_name', 'country_id')))},
  {_INVOICE_MEASURES}, {', '.join(
      has.replace('bool_or', 'coalesce(bool_or', 1).replace(') AS', '), false) AS', 1) for has in _HAS)}
FROM sold GROUP BY invoice_id"""
        ),
        "customer_mode_category": _with(
            f"""known_sold AS (
  SELECT * FROM sold WHERE customer_id IS NOT NULL AND country_name IS NOT NULL),
totals AS (SELECT customer_id, country_name, {_CUSTOMER_MEASURES} FROM known_sold GROUP BY customer_id, country_name),
modes AS (
  SELECT customer_id, country_name, item_category FROM known_sold WHERE item_category IS NOT NULL
  GROUP BY customer_id, country_name, item_category
  QUALIFY row_number() OVER (PARTITION BY customer_id, country_name ORDER BY count(*) DESC, item_category) = 1)""",
            f"""SELECT md5(concat_ws('_', customer_id, country_name)) AS customer_uuid, customer_id, country_name,
  total_sales_amount, total_quantity, total_transactions, total_invoices, total_returns,
  item_category AS favorite_category, {_AVERAGE}
FROM totals LEFT JOIN modes USING (customer_id, country_name)""",
        ),
        "favorite_category": _with(_FAVORITES, "SELECT * FROM favorites"),
        "transaction_id_unique": _with("SELECT count(*) AS n_rows, count(DISTINCT id) AS n_ids FROM fact"),
        "invoice_lookup": _with(_FACT + " WHERE invoice_id = '42' OR event_timestamp_invoiced_at IS NULL"),
        "item_flags": _with(f"SELECT item_uuid, item_description, {_FLAGS} FROM items"),
        "item_flags_masked": _with(
            f"""SELECT item_uuid, item_family_id, is_operational_item,
  CASE WHEN {any_other} THEN nullif(item_id, '') ELSE item_id END AS item_id,
  CASE WHEN {any_other} THEN nullif(item_description, '') ELSE item_description END AS item_description,
  CASE WHEN is_operational_item THEN NULL WHEN {any_other} THEN nullif(item_variant, '')
    ELSE item_variant END AS item_variant,
  {', '.join(f'{flag} AND NOT is_operational_item AS {flag}' for flag in other_flags)}
FROM items"""
        ),
        "item_uuid": _with(
            """SELECT item_id, item_description, sha256(concat_ws('_', item_id, item_description)) AS item_uuid,
  md5(concat_ws('_', item_id, item_description)) AS item_uuid_md5 FROM items"""
        ),
        "item_id_parts": _with(
            """SELECT DISTINCT item_id, CAST(length(item_id) AS INT) AS item_id_length, is_operational_item,
  item_family_id, item_variant FROM items"""
        ),
        "customer_uuid": _with(
            """SELECT DISTINCT customer_id, country_name, md5(concat_ws('_', customer_id, country_name)) AS customer_uuid
FROM stg WHERE customer_id IS NOT NULL AND country_name IS NOT NULL"""
        ),
        "country_locale": _with(
            f"""SELECT country_name, coalesce(locale, {_text(DEFAULT_LOCALE)}) AS locale
FROM (SELECT DISTINCT country_name FROM stg)
LEFT JOIN (VALUES {_LOCALES}) AS v(country_name, locale) USING (country_name)"""
        ),
        "dedup_keep_first": _with(
            """SELECT customer_id, country_name, event_timestamp_invoiced_at AS first_seen FROM stg
WHERE customer_id IS NOT NULL AND country_name IS NOT NULL AND event_timestamp_invoiced_at IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY event_timestamp_invoiced_at, country_name) = 1"""
        ),
        "sample_one_per_key": _with(
            f"""SELECT customer_id, invoice_id, item_id, quantity_amount FROM stg WHERE customer_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY customer_id
  ORDER BY {_draw('customer_id', 'invoice_id', 'item_id', 'quantity_amount')}) = 1"""
        ),
        "sample_rows": _with(items + f" ORDER BY {_draw('item_uuid', 'item_id', 'item_description')} LIMIT 20"),
        "landing_inventory": " UNION ALL ".join(
            f"SELECT '{name}.parquet' AS file, count(*) AS n_rows FROM {name}"
            for name in ("customer", "lineitem", "nation", "orders", "part")
        ),
        "full_build": _with(_DIM_CUSTOMERS, _DATES, _CUSTOMERS, _sums({name: name for name in _SUMS})),
        "warehouse": _with(
            _DIM_CUSTOMERS,
            _DATES,
            _CUSTOMERS,
            _sums(
                {
                    name.replace("int_", "etl_"): name
                    for name in _SUMS
                    if name != "stg_transactions"
                }
            ),
        ),
        "incremental_fact": _with(_FACT),
        "preview_limit": _with(items + " ORDER BY item_uuid, item_id, item_description LIMIT 20"),
        "table_counts": _with(
            _DIM_CUSTOMERS,
            _DATES,
            _CUSTOMERS,
            " UNION ALL ".join(
                f"SELECT '{name}' AS table_name, count(*) AS n_rows, CAST({width} AS INT) AS n_columns FROM {table}"
                for name, (table, _, width) in _SUMS.items()
            ),
        ),
        "description_order": _with(_WEIRD, "SELECT * FROM ordered"),
        "weird_items": _with(_WEIRD, "SELECT * FROM weird"),
        "keyword_class": _with(_WEIRD, "SELECT * FROM classes"),
        "vocabulary_union": _with(_WEIRD, "SELECT * FROM known"),
        "unclassified_items": _with(
            _WEIRD, "SELECT item_description FROM classes EXCEPT SELECT item_description FROM known"
        ),
        "family_text": _with(
            _WORDS,
            """SELECT item_family_id, CAST((n - 1) // 4 AS INT) AS part, string_agg(item_description, ' ' ORDER BY n) AS family_text
FROM (SELECT item_family_id, item_description, row_number() OVER (
    PARTITION BY item_family_id ORDER BY item_description, item_uuid, item_id) AS n FROM plain)
GROUP BY item_family_id, part""",
        ),
        "family_top_words": _with(
            _WORDS,
            """SELECT item_family_id, CAST((n - 1) // 4 AS INT) AS part, string_agg(word, ' ' ORDER BY n) AS item_family_description
FROM (SELECT item_family_id, word, row_number() OVER (PARTITION BY item_family_id ORDER BY word) AS n FROM top_words)
GROUP BY item_family_id, part""",
        ),
        "family_category": _with(
            _WORDS,
            f"""SELECT item_family_id, coalesce(arg_min(category, rule_no), {_text(OTHER_CATEGORY)}) AS item_category
FROM top_words LEFT JOIN (VALUES {_RULES}) AS v(rule_no, keyword, category) ON upper(word) = keyword
GROUP BY item_family_id""",
        ),
        "sales_monthly": _with(
            f"""SELECT {_SORTED_MONTH}, country_name, CAST(sum(total) AS DOUBLE) AS total_sales_amount,
  count(DISTINCT invoice_id) AS total_invoices, count(*) FILTER (is_return) AS total_returns
FROM sold GROUP BY 1, 2"""
        ),
        "customer_overview": _with(
            _CUSTOMERS,
            """SELECT country_name, favorite_category, count(customer_id) AS total_customers,
  CAST(sum(CAST(total_sales_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_sales_amount,
  CAST(sum(total_invoices) AS BIGINT) AS total_invoices, CAST(sum(total_returns) AS BIGINT) AS total_returns
FROM customer_mart GROUP BY country_name, favorite_category""",
        ),
        "category_monthly": _with(
            f"""SELECT {_SORTED_MONTH}, item_category, CAST(sum(total) AS DOUBLE) AS total_sales_amount,
  CAST(sum(quantity_amount) AS BIGINT) AS total_quantity, count(DISTINCT customer_id) AS total_customers
FROM sold GROUP BY 1, 2"""
        ),
        "quality_report": _with(_QUALITY),
    }
    followed = ("dim_customers", "dim_items", "int_items", "int_transactions", "int_invoices", "int_customers")
    checked |= {f"incremental_{name}": checked[name] for name in followed}
    checked["incremental_marts"] = _with(
        _DIM_CUSTOMERS, _CUSTOMERS, _sums({name: name for name in _SUMS if name in followed or name == "fact_transactions"})
    )
    checked["distinct_estimates"] = _with(
        f"""SELECT country_name, CAST(sum(total) AS DOUBLE) AS total_sales_amount, count(DISTINCT invoice_id) AS total_invoices,
  true AS within_error
FROM sold WHERE date >= DATE '2010-03-01' AND date < DATE '2012-11-01' GROUP BY country_name"""
    )
    checked["quarter_sales"] = _with(
        """SELECT CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, day_of_week,
  CAST(sum(total) AS DOUBLE) AS total_sales_amount, count(*) AS n_lines
FROM sold WHERE date >= DATE '2010-04-01' AND date < DATE '2010-07-01' GROUP BY 1, 2, 3"""
    )
    checked["colocated_transactions"] = checked["int_transactions"]
    checked["colocated_items"] = checked["int_items"]
    unreadable = {
        "rejected_quantity": ("Quantity", _int("Quantity")),
        "rejected_price": ("UnitPrice", "try_cast(UnitPrice AS DECIMAL(18,4))"),
        "rejected_customer": ("CustomerID", _int("CustomerID")),
        "rejected_date": ("InvoiceDate", "try_strptime(InvoiceDate, '%m/%d/%y %H:%M')"),
    }
    values = [
        f"SELECT '{reason}' AS reason, InvoiceNo AS invoice_id, StockCode AS item_id, {column} AS text"
        f" FROM raw WHERE {column} IS NOT NULL AND {read} IS NULL"
        for reason, (column, read) in unreadable.items()
    ]
    # a torn record is two malformed lines: the text up to the line break in the quoted description, and the rest
    torn = "torn AS (" + _FEED.split("raw AS (")[1].split("stg AS (")[0].replace(f"NOT ({_TORN})", _TORN).rstrip().rstrip(",")
    rest = " || ',' || ".join(f"coalesce({column}, '')" for column in ("Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"))
    halves = [
        "SELECT 'malformed_line', NULL, NULL, InvoiceNo || ',' || StockCode || ',\"' || upper(name_text) FROM torn_named",
        f"SELECT 'malformed_line', NULL, NULL, 'SECOND LINE\",' || {rest} FROM torn_named",
    ]
    named = torn.replace("SELECT\n", "SELECT p_name AS name_text,\n", 1).replace("torn AS", "torn_named AS", 1)
    checked["quarantine"] = _with(named, " UNION ALL ".join([*values, *halves]))
    checked["quarantine_balance"] = _with(
        f"""SELECT count(*) + count(*) FILTER ({_TORN}) AS n_records, count(*) FILTER (NOT ({_TORN})) AS n_loaded,
  2 * count(*) FILTER ({_TORN}) AS n_quarantined, true AS adds_up FROM lines"""
    )
    checked["landing_manifest"] = _with(
        """a AS (SELECT count(*) AS n FROM raw WHERE CustomerID IS NULL),
b AS (SELECT count(*) AS n, count(Quantity) AS known FROM raw WHERE CustomerID IS NOT NULL)""",
        """SELECT CAST(check_id AS BIGINT) AS check_id, status, CAST(n_files AS BIGINT) AS n_files, CAST(n_rows AS BIGINT) AS n_rows, status <> 'gone' OR NULL AS has_size
FROM a, b, LATERAL (VALUES (0, 'new', 2, a.n + b.n), (1, 'unchanged', 1, a.n), (1, 'redelivered', 1, a.n), (1, 'gone', 1, b.n), (1, 'new', 1, b.known),
  (2, 'unchanged', 3, 2 * a.n + b.known)) AS v(check_id, status, n_files, n_rows)""",
    )
    return checked
