"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What separates words, as a Java and as a DuckDB pattern.
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def filled(text: Column | str) -> Column:
    """The text, '' where it is NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column | str) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Words between ASCII white space, in order, as an array."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def byte_words(text: str | None) -> list[bytes]:
    """The same words in a Python task, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8").lower().split() if text else []


def crc_remainder(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; NULL ids count as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def input_bytes(df: DataFrame, text: str) -> int:
    """UTF-8 bytes of a text column, one number for the driver; sizes partitions."""
    return df.agg(F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0)).alias("n")).first().n


def sampled(df: DataFrame, rows: int, most: int, *key: str) -> DataFrame:
    """About ``most`` of a table's ``rows`` rows, or all if they are no more: those whose key hashes below a threshold.

    Every task decides for its own rows; nothing is sorted or gathered to draw.
    """
    if rows <= most:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit("sample"), *key), F.lit(1 << 40)) < int((1 << 40) * most / rows))


def rows_of(batches: Iterator, *columns: str) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples of Python values, one batch in memory at a time."""
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def packed(df: DataFrame) -> Column:
    """A row's columns as one struct, which no other column's name can clash with."""
    return F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in df.columns)).alias("_row")


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def ship(df: DataFrame) -> DataFrame:
    """``df``, after making sure that Python workers can import this package.

    Where the package is on no path that workers inherit, Spark is handed its
    modules as a Python file, as ``--py-files`` would do; once per application.
    """
    context = df.sparkSession.sparkContext
    inherited = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT in inherited or context.applicationId in _SHIPPED:
        return df
    folder = tempfile.TemporaryDirectory()  # the driver serves the file from here until it ends
    path = os.path.join(folder.name, "texttrend_llm.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for at, _, names in os.walk(os.path.join(_ROOT, "texttrend")):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(at, name)
                    archive.write(file, os.path.relpath(file, _ROOT))
    context.addPyFile(path)
    _SHIPPED[context.applicationId] = folder
    return df
