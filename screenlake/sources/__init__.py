"""Readers and writers."""
from .tables import TABLES, read_table, table_path  # noqa: F401
