"""A Spark library that lands CSV files as typed tables and normalises JSON array columns."""

from silverlode.model import BRONZE, JSON_TABLES, MOVIES_CORE, MOVIES_SILVER, JsonTable, struct
from silverlode.operators import core_movies, fill_defaults, normalize, rejected
from silverlode.plans import build_silver, ingest, run_pipeline, silver_tables
from silverlode.sinks import delete_releases, read_release, verify_release, write_bronze, write_release, write_silver
from silverlode.sources import read_csv, scan_bronze

__all__ = [
    "BRONZE",
    "JSON_TABLES",
    "MOVIES_CORE",
    "MOVIES_SILVER",
    "JsonTable",
    "build_silver",
    "core_movies",
    "delete_releases",
    "fill_defaults",
    "ingest",
    "normalize",
    "read_csv",
    "read_release",
    "rejected",
    "run_pipeline",
    "scan_bronze",
    "silver_tables",
    "struct",
    "verify_release",
    "write_bronze",
    "write_release",
    "write_silver",
]
