"""Files that only one of several writers can create: the base of numbered runs and commit logs."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def publish_once(spark: SparkSession, path: str, content: dict) -> bool:
    """Create ``path`` with ``content`` as one JSON line; False if it exists already.

    The content is written under a name of its own and then moved into place
    whole, which fails where the name is taken: by a hard link on a local disk,
    by a rename elsewhere. HDFS and stores with its semantics decide a rename
    atomically; a plain object store does not, and needs a committer that does.
    """
    fs, target = _file_system(spark, path)
    target = fs.makeQualified(target)
    fs.mkdirs(target.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray((json.dumps(content) + "\n").encode()))
    out.close()
    try:
        if fs.getUri().getScheme() != "file":
            return bool(fs.rename(draft, target))
        java = spark._jvm.java
        to_path = java.nio.file.Paths.get
        try:
            java.nio.file.Files.createLink(to_path(target.toUri()), to_path(draft.toUri()))
            return True
        except Exception as error:
            if "FileAlreadyExistsException" in str(error):
                return False
            raise
    finally:
        fs.delete(draft, False)


def published(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the published files that match a glob pattern, sorted; only the folder is read."""
    fs, target = _file_system(spark, pattern)
    names = [status.getPath().getName() for status in fs.globStatus(target) or []]
    return sorted(n for n in names if not n.startswith("."))


def read_published(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """The contents of published files as a table; no rows where there are none."""
    try:
        return spark.read.schema(schema).json(pattern)
    except AnalysisException:
        if published(spark, pattern):
            raise
        return spark.createDataFrame([], schema)
