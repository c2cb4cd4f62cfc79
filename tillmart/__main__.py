"""Command line: ``python -m tillmart --sales F --families F --out DIR``."""

import argparse

from tillmart.plans.batch import FLAG_READINGS, load_warehouse, run_batch
from tillmart.schemas import RAW_FAMILIES, RAW_SALES, TABLES, as_text, conform
from tillmart.session import build_session
from tillmart.sources.files import RETAIL_ENCODING, read_csv, well_formed


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tillmart", description=__doc__)
    parser.add_argument("--sales", required=True, help="CSV of sales lines")
    parser.add_argument("--families", required=True, help="CSV of item families")
    parser.add_argument("--out", required=True, help="folder for the tables")
    parser.add_argument("--locations", help="CSV of countries; without it the built-in ones")
    parser.add_argument("--encoding", default=RETAIL_ENCODING, help="of the sales CSV")
    parser.add_argument("--monthly", action="store_true", help="lay the fact and the transactions mart out by month")
    parser.add_argument("--flags", choices=list(FLAG_READINGS), default="exact", help="how descriptions are compared")
    parser.add_argument("--multi-line", action="store_true", help="records may hold quoted line breaks")
    parser.add_argument("--database", help="also load the tables into this catalog database")
    options = parser.parse_args(arguments)

    spark = build_session()
    locations = None
    if options.locations:
        schema = TABLES["dim_location"]
        locations = conform(well_formed(read_csv(spark, options.locations, as_text(schema))), schema)
    run_batch(
        spark,
        well_formed(read_csv(spark, options.sales, RAW_SALES, options.encoding, options.multi_line)),
        well_formed(read_csv(spark, options.families, RAW_FAMILIES)),
        options.out,
        locations,
        options.monthly,
        options.flags,
    )
    if options.database:
        load_warehouse(spark, options.out, options.database)


if __name__ == "__main__":
    main()
