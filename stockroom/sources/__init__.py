from stockroom.sources.tables import load, read_table, table_path

__all__ = ["load", "read_table", "table_path"]
