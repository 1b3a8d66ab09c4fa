"""Helpers shared by the corpus operators.

Conventions of the package: a null text counts as empty, operators read
only the columns they name (extra columns of any name pass unseen), and
intermediate tables are checkpointed into ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path

#: White space of every contract: blank and \t \n \v \f \r, as a regex class body (Java and Python alike).
WS = r"\x20\x09-\x0D"
WORD_RE = re.compile(rf"[^{WS}]+")
_UPPER = {c: c + 32 for c in range(65, 91)}
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole(text: Column | str) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of characters that are no white space."""
    return F.array_remove(F.split(text, f"[{WS}]+"), "")


def lower_ascii(s: str) -> str:
    """A-Z lower-cased, everything else untouched."""
    return s.lower() if s.isascii() else s.translate(_UPPER)


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor`` (a null id counts as the empty text)."""
    return F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8")) % divisor


def landed(df: DataFrame) -> DataFrame:
    """Materialise a frame in the shared checkpoint folder and cut its lineage there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def landed_parquet(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """As landed(), as a compressed columnar table: for wide or long intermediates."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """A folder of landed tables, removed together when they are read no more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, scratch_path(spark, f"{name}-{uuid.uuid4().hex}")

    def land(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path, compression="zstd")
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def configured(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Within, the session has these settings."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shuffles_freed(spark: SparkSession):
    """Within, Spark removes the shuffle files of each query that has ended: what is landed needs them no more."""
    return configured(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})
