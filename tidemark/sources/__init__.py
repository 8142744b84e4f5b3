from .tables import TABLES, load, load_all, read_csv, enforce_schema  # noqa: F401
