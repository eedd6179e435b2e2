"""Session helpers: settings for the caller's own builder, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def s3a_settings(
    access_key: str, secret_key: str, endpoint: str, path_style: bool = True, bucket: str | None = None
) -> dict[str, str]:
    """Hadoop settings for an S3-compatible store, or one bucket of it; needs the ``hadoop-aws`` jar on the cluster.

    They are what the jobs take as ``stores``; for a session's builder, put ``spark.hadoop.`` before each.
    """
    prefix = f"fs.s3a.bucket.{bucket}." if bucket else "fs.s3a."
    return {
        prefix + "access.key": access_key,
        prefix + "secret.key": secret_key,
        prefix + "endpoint": endpoint,
        prefix + "path.style.access": str(path_style).lower(),
        "fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def delta_settings() -> dict[str, str]:
    """Spark settings that switch Delta tables on; needs the Delta jar for the running Spark."""
    return {
        "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
        "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
    }


def build_session(app_name: str, *settings: dict[str, str]) -> SparkSession:
    """A session with the given settings; later ones win."""
    builder = SparkSession.builder.appName(app_name)
    for group in settings:
        for key, value in group.items():
            builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (``spark.checkpoint.dir``).

    Only a local session may leave that setting out, and then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="silverlode-")
    return f"{base.rstrip('/')}/silverlode/{uuid.uuid4().hex}/{name}"


class Scratch:
    """Tables that a job writes down on its way, in the shared folder, until it is done."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._folder = scratch_path(spark, "tables")
        self._used = False

    def path(self, name: str) -> str:
        self._used = True
        return f"{self._folder}/{name}"

    def clear(self) -> None:
        if self._used:
            delete(self._spark, self._folder)


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _files(spark, path)
    return files.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it."""
    files, at = _files(spark, path)
    files.delete(at, True)


def replace_folder(spark: SparkSession, path: str, by: str) -> None:
    """Put the folder ``by`` in the place of ``path``, whose content goes."""
    files, at = _files(spark, path)
    files.delete(at, True)
    if not files.rename(_files(spark, by)[1], at):
        raise OSError(f"{by} could not be renamed to {path}")
    spark.catalog.refreshByPath(path)


def list_folder(spark: SparkSession, path: str) -> dict[str, float]:
    """The names in a folder and when each was last changed, in seconds; none if it is not there."""
    files, at = _files(spark, path)
    if not files.exists(at):
        return {}
    return {s.getPath().getName(): s.getModificationTime() / 1000 for s in files.listStatus(at)}


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, on the driver."""
    files, at = _files(spark, path)
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place as a whole; False if one is there already, which is left alone.

    The file is written under another name and renamed. HDFS refuses the rename if the name was taken in the meantime;
    other stores may only be looked at before it.
    """
    files, at = _files(spark, path)
    written = _files(spark, f"{path}.{uuid.uuid4().hex}.tmp")[1]
    stream = files.create(written, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        done = not files.exists(at) and files.rename(written, at)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error.java_exception):
            raise
        done = False
    if not done:
        files.delete(written, False)
    return done


def _files(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def own_session(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session of the same application that starts with the caller's settings and then has ``settings``.

    A job that needs settings of its own runs in one, so that jobs side by side, and the caller, keep theirs.
    """
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **settings}.items():
        if own.conf.get(key, None) != value:
            own.conf.set(key, value)
    return own
