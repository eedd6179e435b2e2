"""The jobs a user calls: CSV to Bronze, Bronze to Silver, and both in order."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

from silverlode.model import BRONZE, JSON_TABLES, MOVIES_CORE, MOVIES_SILVER
from silverlode.operators import core_movies, normalize, normalize_marked
from silverlode.session import Scratch, own_session
from silverlode.sinks import ROWS_PER_FILE, delete_releases, write_bronze, write_release, write_silver
from silverlode.sources import check_footers, column_shares, read_csv, scan_bronze

# Bytes that a Silver task should read. Its split holds far more file, as a job reads few columns of many; larger splits
# mean fewer, fuller tasks and output files. Small inputs still spread over all cores.
TASK_BYTES = 128 << 20
LARGEST_SPLIT = 4 << 30

# Files of accepted and rejected rows stay open side by side, so that rows need not be sorted by which they are.
REJECT_SETTINGS = {"spark.sql.maxConcurrentOutputFileWriters": "2"}

JOBS_AT_ONCE = 4
RELEASES_KEPT = 2


@dataclass(frozen=True)
class Loaded:
    """What a load wrote, and by column how many texts became null as they are not of the declared type."""

    rows: int
    lost: dict[str, int]

    def __str__(self) -> str:
        lost = ", ".join(f"{name}: {n}" for name, n in self.lost.items() if n)
        return f"{self.rows} rows" + (f"; texts not of their column's type: {lost}" if lost else "")


def ingest(
    spark: SparkSession,
    csv_path: str,
    bronze_path: str,
    schema: StructType | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    mode: str = "overwrite",
    most_lost: int | None = None,
) -> Loaded:
    """Load CSV files into a Bronze table, typed by ``schema`` or, without one, by the data.

    The rows, and the texts that became null, are counted on their way to the files. If more than ``most_lost``
    texts did, the load fails and the old table stays.
    """
    scratch, seen = Scratch(spark), Observation()

    def accept() -> None:
        lost = _loaded(seen).lost
        if most_lost is not None and sum(lost.values()) > most_lost:
            raise ValueError(f"{csv_path}: more than {most_lost} texts are not of their column's type: {lost}")

    try:
        rows = read_csv(spark, csv_path, schema, scratch=scratch, spread=True, losses=seen)
        write_bronze(rows, bronze_path, rows_per_file, mode, accept)
        return _loaded(seen)
    finally:
        scratch.clear()


def _loaded(seen: Observation) -> Loaded:
    found = seen.get
    return Loaded(found["rows"], {name.removeprefix("lost "): n for name, n in found.items() if name != "rows"})


def silver_tables(bronze: dict[str, DataFrame]) -> dict[str, tuple[DataFrame, StructType]]:
    """Every Silver table and its declared schema, from the Bronze tables by name."""
    return {name: _silver_table(bronze, name) for name in silver_columns()}


def _silver_table(bronze: dict[str, DataFrame], name: str, rejects: bool = False) -> tuple[DataFrame, StructType]:
    if name == "movies":
        return core_movies(bronze["movies"]), MOVIES_SILVER
    table = JSON_TABLES[name]
    rows = (normalize_marked if rejects else normalize)(bronze[table.source], table)
    return rows, table.output_schema(BRONZE[table.source])


def build_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    fmt: str = "delta",
    rejects: bool = False,
    stores: dict[str, str] | None = None,
    check: bool = True,
) -> list[str]:
    """Write all Silver tables and return their names.

    As ``parquet``, all tables become readable at once, by ``read_release``, and the release before stays for those that
    still read it; a load that fails or is killed changes nothing. With ``rejects``, documents that cannot be read
    are written too, by the same jobs, as tables ``<name>_rejects``. As ``delta``, each table is overwritten by
    itself; if one fails, the error carries a note of those that were written.

    ``check`` compares the footers of all Bronze files with the declared columns first. Each table is its own map-only job over its own columns, so nothing is cached. A few jobs run at
    a time, so that one's last tasks do not leave the cluster idle. They run in sessions of their own, with the
    caller's settings, split sizes for the columns that they read, and settings for ``stores``.
    """
    if rejects and fmt != "parquet":
        raise ValueError("rejects are written as parquet only")
    own = own_session(spark, stores or {})

    def look_at(name: str) -> dict[str, float]:
        if check:
            check_footers(own, f"{bronze_path}/{name}", BRONZE[name])
        return column_shares(own, f"{bronze_path}/{name}")

    with ThreadPoolExecutor(len(BRONZE)) as pool:
        shares = dict(zip(BRONZE, pool.map(look_at, BRONZE), strict=True))
    tables = {}
    for name, columns in silver_columns().items():
        source = "movies" if name == "movies" else JSON_TABLES[name].source
        settings = {"spark.sql.files.maxPartitionBytes": str(split_bytes(shares[source], columns))}
        session = own_session(own, {**settings, **(REJECT_SETTINGS if rejects else {})})
        bronze = {source: scan_bronze(session, f"{bronze_path}/{source}", BRONZE[source], check=False)}
        tables[name] = _silver_table(bronze, name, rejects)
    if fmt == "parquet":
        marked = {name: t.reject_schema(BRONZE[t.source]) for name, t in JSON_TABLES.items()} if rejects else None
        write_release(own, silver_path, tables, rejects=marked)
        delete_releases(own, silver_path, RELEASES_KEPT)
        return list(tables)
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        jobs = {
            name: pool.submit(write_silver, df, f"{silver_path}/{name}", schema, fmt)
            for name, (df, schema) in tables.items()
        }
    failed = {name: job.exception() for name, job in jobs.items() if job.exception()}
    written = [name for name in jobs if name not in failed]
    for error in failed.values():
        error.add_note(f"Silver tables not written: {list(failed)}; written: {written}")
        raise error
    return written


def silver_columns() -> dict[str, list[str]]:
    """The Bronze columns that the job of each Silver table reads."""
    names = ["crew", "cast", "movies", *JSON_TABLES]
    found = {name: [*JSON_TABLES[name].parents, JSON_TABLES[name].column] for name in JSON_TABLES}
    return {name: found.get(name, list(MOVIES_CORE)) for name in dict.fromkeys(names)}


def split_bytes(shares: dict[str, float], columns: list[str]) -> int:
    """File bytes of a split of which the columns given are about ``TASK_BYTES``."""
    share = sum(shares.get(name, 0) for name in columns)
    return int(min(LARGEST_SPLIT, max(TASK_BYTES, TASK_BYTES / share))) if share > 0 else TASK_BYTES


def run_pipeline(
    spark: SparkSession,
    movies_csv: str,
    credits_csv: str,
    bronze_path: str,
    silver_path: str,
    fmt: str = "delta",
    rows_per_file: int = ROWS_PER_FILE,
    rejects: bool = False,
    stores: dict[str, str] | None = None,
) -> list[str]:
    """Load movies and credits side by side, then build all Silver tables. ``stores`` has Hadoop settings for this run alone.

    If a load fails, its old Bronze table stays, the other load goes on, and nothing is built.
    """
    own = own_session(spark, stores or {})
    with ThreadPoolExecutor(len(BRONZE)) as pool:
        jobs = [
            pool.submit(ingest, own, csv_path, f"{bronze_path}/{name}", BRONZE[name], rows_per_file)
            for name, csv_path in (("movies", movies_csv), ("credits", credits_csv))
        ]
    for job in jobs:
        job.result()
    return build_silver(own, bronze_path, silver_path, fmt, rejects, check=False)  # these files were just written
