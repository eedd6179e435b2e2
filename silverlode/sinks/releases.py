"""Releases: tables that one load writes become readable together, by one small file that is put in place last.

    <root>/loads/<load>/<table>/part-*.parquet     never changed once written; in two folders if rejects are kept
    <root>/manifests/<version>.json                names the folder of every table; the highest number is current

A load writes new folders beside old ones, so readers of the current release are not disturbed, and a load that fails or
is killed at any point leaves nothing but folders that no manifest names.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from silverlode.functions import quoted
from silverlode.model import REJECTED, check_schema
from silverlode.session import delete, exists, list_folder, put_new, read_text

JOBS_AT_ONCE = 4

# A manifest that another load puts in place first is built upon; so many in a row mean that something else is wrong.
ATTEMPTS = 100

# Folders that no manifest names may belong to a load that still runs, unless nothing was written there for so long.
ABANDONED_SECONDS = 7 * 24 * 3600

_MANIFEST = re.compile(r"([0-9]{12})\.json")


@dataclass(frozen=True)
class Table:
    """One table of a release: its folder below the root, declared columns, and what was written."""

    folder: str
    schema: StructType
    rows: int
    digest: str

    def to_json(self) -> dict:
        return {"folder": self.folder, "schema": self.schema.jsonValue(), "rows": self.rows, "digest": self.digest}

    @classmethod
    def from_json(cls, found: dict) -> Table:
        return cls(found["folder"], StructType.fromJson(found["schema"]), found["rows"], found["digest"])


@dataclass(frozen=True)
class Release:
    version: int
    tables: dict[str, Table]


def digest(columns: list[str], own: Column | None = None) -> Column:
    """An aggregate over all rows (or ``own`` ones) that their order and partitions do not change.

    Three sums of 20 bits of each row's hash, which hold 2^43 rows, as text.
    """
    hashed = F.xxhash64(*[F.col(quoted(c)) for c in columns])
    hashed = hashed if own is None else F.when(own, hashed)
    parts = [F.sum(F.shiftrightunsigned(hashed, shift).bitwiseAND(0xFFFFF)) for shift in (0, 20, 40)]
    return F.concat_ws("-", *[F.coalesce(part, F.lit(0)) for part in parts])


def write_release(
    spark: SparkSession,
    root: str,
    tables: dict[str, tuple[DataFrame, StructType]],
    carry: bool = False,
    rejects: dict[str, StructType] | None = None,
) -> Release:
    """Write every table and then make them current at once; a few jobs run at a time.

    Each table is checked against its declared schema before anything is written, and its rows are counted and
    digested on their way to the files, without a pass of their own. With ``carry``, tables of the current release
    that are not written stay in the new one; without, a release has just the tables given. If a job fails, what the
    load has written is deleted, and the current release stays.

    ``rejects`` has the schemas of tables whose rows come marked by ``operators.normalize_marked``: rows that are
    rejected go, by the same job, to a table of that name and ``_rejects``.

    Of two loads at the same time, the one that commits last is current; with ``carry``, it builds on the other.
    """
    root, rejects = root.rstrip("/"), rejects or {}
    for name, (df, schema) in tables.items():
        marked = set(schema.names) | set(rejects[name].names) | {REJECTED} if name in rejects else set()
        found = StructType([f for f in df.schema if f.name in schema.names or f.name not in marked])
        check_schema(found, schema, f"{root}, {name}")
        if exists(spark, f"{root}/{name}/_delta_log"):
            raise ValueError(f"{root}/{name} is a Delta table; a Parquet release beside it would be taken for newer rows of it")
    load = f"{time.strftime('%Y%m%dT%H%M%SZ', time.gmtime())}-{uuid.uuid4().hex}"

    def write(name: str) -> dict[str, Table]:
        df, schema = tables[name]
        folder = f"loads/{load}/{name}"
        parts = {name: (F.lit(True), schema, "")}
        if name in rejects:
            parts = {
                name: (~F.col(REJECTED), schema, f"/{REJECTED}=false"),
                f"{name}_rejects": (F.col(REJECTED), rejects[name], f"/{REJECTED}=true"),
            }
        seen, measures = Observation(), []
        for i, (own, columns, _) in enumerate(parts.values()):
            measures += [F.count_if(own).alias(f"rows_{i}"), digest(columns.names, own).alias(f"digest_{i}")]
        writer = df.observe(seen, *measures).write.option("compression", "zstd")
        (writer.partitionBy(REJECTED) if name in rejects else writer).parquet(f"{root}/{folder}")
        found = seen.get
        return {
            part: Table(folder + below, columns, found[f"rows_{i}"], found[f"digest_{i}"])
            for i, (part, (_, columns, below)) in enumerate(parts.items())
        }

    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        jobs = {name: pool.submit(write, name) for name in tables}
    failed = {name: job.exception() for name, job in jobs.items() if job.exception()}
    for error in failed.values():
        delete(spark, f"{root}/loads/{load}")
        error.add_note(f"not written: {list(failed)}; no table of this load is visible, the release before it is current")
        raise error
    return _commit(spark, root, {part: table for job in jobs.values() for part, table in job.result().items()}, carry)


def _commit(spark: SparkSession, root: str, written: dict[str, Table], carry: bool) -> Release:
    for _ in range(ATTEMPTS):
        before = current(spark, root)
        kept = before.tables if before and carry else {}
        release = Release(before.version + 1 if before else 1, {**kept, **written})
        content = {"version": release.version, "tables": {name: t.to_json() for name, t in release.tables.items()}}
        if put_new(spark, f"{root}/manifests/{release.version:012d}.json", json.dumps(content, indent=1)):
            return release
    raise OSError(f"{root}: no manifest could be put in place")


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all releases that can be read, in order."""
    names = list_folder(spark, f"{root.rstrip('/')}/manifests")
    return sorted(int(m[1]) for m in map(_MANIFEST.fullmatch, names) if m)


def current(spark: SparkSession, root: str) -> Release | None:
    found = versions(spark, root)
    return release_of(spark, root, found[-1]) if found else None


def release_of(spark: SparkSession, root: str, version: int) -> Release:
    content = json.loads(read_text(spark, f"{root.rstrip('/')}/manifests/{version:012d}.json"))
    return Release(content["version"], {name: Table.from_json(t) for name, t in content["tables"].items()})


def read_release(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of the current release, or of an older one that was not deleted: all of one load, also while another runs."""
    release = current(spark, root) if version is None else release_of(spark, root, version)
    if release is None:
        raise FileNotFoundError(f"{root}: there is no release")
    root = root.rstrip("/")

    def rows(t: Table) -> DataFrame:
        if not t.rows and REJECTED in t.folder:  # then there is no such folder
            return spark.createDataFrame([], t.schema)
        return spark.read.schema(t.schema).parquet(f"{root}/{t.folder}")

    return {name: rows(t) for name, t in release.tables.items()}


def verify_release(spark: SparkSession, root: str, version: int | None = None) -> dict[str, str]:
    """Tables whose files no longer hold what was written, each with what is wrong; empty if all is well."""
    release = current(spark, root) if version is None else release_of(spark, root, version)
    wrong = {}
    for name, df in read_release(spark, root, release.version).items():
        table = release.tables[name]
        found = df.agg(F.count(F.lit(1)).alias("rows"), digest(df.columns).alias("digest")).first()
        if (found["rows"], found["digest"]) != (table.rows, table.digest):
            wrong[name] = f"{found['rows']} rows of digest {found['digest']}, written: {table.rows} of {table.digest}"
    return wrong


def delete_releases(spark: SparkSession, root: str, keep: int = 2, abandoned_seconds: int = ABANDONED_SECONDS) -> list[int]:
    """Delete all but the last ``keep`` releases, and folders of loads that were never finished; the numbers deleted.

    Manifests go first, so none ever names a folder that is gone. A job that still reads a deleted release fails.
    """
    if keep < 1:
        raise ValueError(f"keep must be positive, not {keep}")
    root = root.rstrip("/")
    found = versions(spark, root)
    gone, left = found[:-keep], found[-keep:]
    dropped = {t.folder for v in gone for t in release_of(spark, root, v).tables.values()}
    used = {t.folder for v in left for t in release_of(spark, root, v).tables.values()}
    for version in gone:
        delete(spark, f"{root}/manifests/{version:012d}.json")
    for folder in dropped - used:
        delete(spark, f"{root}/{folder}")
    loads = {folder.split("/")[1] for folder in used}
    for name, changed in list_folder(spark, f"{root}/loads").items():
        old = time.time() - changed > abandoned_seconds or name in {folder.split("/")[1] for folder in dropped}
        if name not in loads and old:
            delete(spark, f"{root}/loads/{name}")
    return gone
