"""Cut lineage by writing a table into the folder all executors share.

The folder is spark.checkpoint.dir; only where the session has none (tests, local work) is one made.
A written table survives the loss of executors, is columnar and compressed, and is read back with
column pruning, which an RDD checkpoint is not.
"""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, or a private one made for a session without it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        _OWN[app] = tempfile.mkdtemp(prefix="rateloom-")
        atexit.register(shutil.rmtree, _OWN[app], ignore_errors=True)
    return "file://" + _OWN[app]


_CLEAN: set[str] = set()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path of this application's own in the shared folder; what is there is dropped when Python ends."""
    root = f"{shared_dir(spark)}/rateloom-{spark.sparkContext.applicationId}"
    if root not in _CLEAN:
        _CLEAN.add(root)
        atexit.register(_drop, spark, root)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def _drop(spark: SparkSession, root: str) -> None:
    if root.startswith(("/", "file:")):
        shutil.rmtree(local_path(root), ignore_errors=True)
        return
    try:
        fs, path = hadoop_fs(spark, root)
        fs.delete(path, True)
    except Exception:  # the JVM may have gone first
        pass


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df once and return a reader of it. Eager: it runs a job."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hadoop_fs(spark: SparkSession, path: str):
    """The Hadoop file system and path object of a location, for renames and small files."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file (a manifest), or None where it is missing."""
    fs, jpath = hadoop_fs(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file whole or not at all, and never over another; False where the name is taken.

    It is written aside and renamed without overwriting, which the file system refuses if another writer came first.
    """
    jvm = spark.sparkContext._jvm
    fs, jpath = hadoop_fs(spark, path)
    _, aside = hadoop_fs(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    never = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    never[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(jpath.toUri() if jpath.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(files.makeQualified(aside), files.makeQualified(jpath), never)
    except Exception as e:
        fs.delete(aside, False)
        if "FileAlreadyExists" in str(e):
            return False
        raise
    return True


class ConflictError(RuntimeError):
    """Another writer has committed since this one read the manifest."""


class Manifests:
    """The versions of a table or folder: one numbered file for each, never changed, moved or replaced.

    The highest number is the current version, so a commit is the appearance of one file: a reader sees the version
    before it or after it, and a run that dies at any moment leaves the version before it.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = "manifest"):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name

    def latest(self) -> dict | None:
        """The current version with its number as `version`, or None before the first."""
        fs, found = hadoop_fs(self.spark, f"{self.path}/{self.name}-*.json")
        paths = [x.getPath().toString() for x in fs.globStatus(found) or []]
        return json.loads(read_text(self.spark, max(paths))) if paths else None

    def commit(self, manifest: dict) -> dict:
        """Make the manifest the version after its own `version` (the first where it has none)."""
        n = manifest.get("version", -1) + 1
        new = dict(manifest, version=n)
        if not create_text(self.spark, f"{self.path}/{self.name}-{n:010d}.json", json.dumps(new)):
            raise ConflictError(f"version {n} of {self.path} is taken")
        return new


def local_path(path: str) -> str:
    return "/" + path.split(":", 1)[1].lstrip("/") if path.startswith("file:") else path
