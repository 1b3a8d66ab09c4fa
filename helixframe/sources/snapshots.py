"""A table of Parquet files behind snapshots.

``data/<load>/`` holds files that are never changed, ``manifests/<load>``
the list of a snapshot's files, ``snapshots/<version>`` a pointer to one
manifest.  A pointer is created once and never overwritten, so a snapshot
appears whole or not at all, and of two writers of one version the second
fails.  File lists pass the driver, as in any file reader; rows do not.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


class SnapshotConflict(RuntimeError):
    """Another writer published the version first."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions, ascending."""
    fs, p = _fs(spark, f"{path}/snapshots")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n) for n in names if n.isdigit())


def snapshot_files(spark: SparkSession, path: str, version: int | None = None) -> list[str]:
    """Files of a version (the latest by default)."""
    if version is None:
        version = versions(spark, path)[-1]
    load = spark.read.text(f"{path}/snapshots/{version:08d}").first()[0]
    return [r[0] for r in spark.read.parquet(f"{path}/manifests/{load}").select("file").collect()]


def _publish(spark: SparkSession, path: str, load: str, files: list[str], version: int) -> int:
    spark.createDataFrame([(f,) for f in files], "file string").coalesce(1).write.parquet(f"{path}/manifests/{load}")
    fs, p = _fs(spark, f"{path}/snapshots/{version:08d}")
    if fs.exists(p):
        raise SnapshotConflict(f"version {version} of {path} exists")
    try:
        out = fs.create(p, False)
    except Exception as e:
        raise SnapshotConflict(f"version {version} of {path} exists") from e
    out.write(bytearray(load.encode()))
    out.close()
    return version


def _write(df: DataFrame, path: str, load: str) -> list[str]:
    df.write.parquet(f"{path}/data/{load}")
    return sorted(df.sparkSession.read.parquet(f"{path}/data/{load}").inputFiles())


def _next_load(df: DataFrame, path: str, cluster_by: list[str], num_files: int, keep: bool) -> int:
    spark = df.sparkSession
    load, last = uuid.uuid4().hex, (versions(spark, path) or [0])[-1]
    old = snapshot_files(spark, path, last) if keep and last else []
    return _publish(spark, path, load, old + _write(df.repartitionByRange(num_files, *cluster_by), path, load), last + 1)


def write_table(df: DataFrame, path: str, cluster_by: list[str], num_files: int) -> int:
    """Publish ``df`` as the table's next version, its rows dealt to files by
    ranges of ``cluster_by`` (end it with the row's id: one hot value is then
    cut into many files)."""
    return _next_load(df, path, cluster_by, num_files, keep=False)


def append_table(df: DataFrame, path: str, cluster_by: list[str], num_files: int) -> int:
    """Publish the last version's files and those of ``df`` as the next version."""
    return _next_load(df, path, cluster_by, num_files, keep=True)


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return spark.read.parquet(*snapshot_files(spark, path, version))


def rewrite_without(spark: SparkSession, path: str, ids: DataFrame, id_col: str) -> int:
    """Publish a version without the rows whose id is in ``ids`` (a frame with
    that column, small or large).  Only files that hold such a row are
    rewritten; the others pass on under their names.  Rows without an id
    stay.  Without any match the version stays as it is."""
    from ..operators.joins import sized_lookup

    version = versions(spark, path)[-1]
    files = snapshot_files(spark, path, version)
    gone = ids.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    gone = sized_lookup(gone)
    live = spark.read.parquet(*files)
    held = live.select(id_col, F.col("_metadata.file_name").alias("_file")).join(gone, id_col, "left_semi")
    names = {r[0] for r in held.select("_file").distinct().collect()}
    hit = [f for f in files if f.rsplit("/", 1)[1] in names]
    if not hit:
        return version
    load = uuid.uuid4().hex
    fresh = _write(spark.read.parquet(*hit).join(gone, id_col, "left_anti").select(*live.columns), path, load)
    return _publish(spark, path, load, sorted(set(files) - set(hit)) + fresh, version + 1)


def purge(spark: SparkSession, path: str) -> int:
    """Delete the versions before the latest and the files only they hold;
    returns the number of files."""
    *old, last = versions(spark, path)
    keep = set(snapshot_files(spark, path, last))
    dead = set().union(*(snapshot_files(spark, path, v) for v in old)) - keep
    for v in old:  # pointers first: no reader starts on files about to go
        fs, p = _fs(spark, f"{path}/snapshots/{v:08d}")
        fs.delete(p, False)
    for f in sorted(dead):
        fs, p = _fs(spark, f)
        fs.delete(p, False)
    return len(dead)
