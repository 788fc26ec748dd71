from tessera.sources.tables import LINE_ORDER, TABLES, raw_shares, read_table, sales, sales_raw  # noqa: F401
