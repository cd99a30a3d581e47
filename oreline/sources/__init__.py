from oreline.sources.catalog import SourceCatalog, rows_df
from oreline.sources.csv import HeaderMismatch, ingest, read_typed_csv

__all__ = ["HeaderMismatch", "SourceCatalog", "ingest", "read_typed_csv", "rows_df"]
