"""brookmark: incremental medallion, change-log and star-schema analytics on Spark DataFrames."""

from brookmark.specs import CATALOG, TableSpec, load_specs

__all__ = ["CATALOG", "TableSpec", "load_specs"]
