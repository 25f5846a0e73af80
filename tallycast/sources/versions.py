"""Folders that appear whole: versions, a manifest of each, and a pointer that is set last."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST, POINTER = "manifest", "CURRENT"


def new_version() -> str:
    return f"v{time.time_ns()}-{uuid.uuid4().hex[:8]}"


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """Path below the folder, length and checksum of every file but the manifest; each file is read by one task."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    name = F.substring_index("path", f"/{folder.rstrip('/').rsplit('/', 1)[-1]}/", -1)
    listed = found.select(name.alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    return listed.filter(~F.col("file").startswith(f"{MANIFEST}/"))


def _schemas(spark: SparkSession, files: list[str], folder: str) -> dict[str, str]:
    tables = sorted({f.rsplit("/", 1)[0] for f in files if f.endswith(".parquet")})
    return {t: spark.read.parquet(f"{folder}/{t}").schema.json() for t in tables}


def write_manifest(spark: SparkSession, folder: str) -> None:
    """What the folder holds: every file with its checksum, and the schema of every table."""
    files = sorted(tuple(r) for r in _files(spark, folder).collect())
    content = json.dumps({"files": files, "schemas": _schemas(spark, [f for f, _, _ in files], folder)})
    spark.createDataFrame([(content,)], "content string").coalesce(1).write.parquet(f"{folder}/{MANIFEST}")


def check_manifest(spark: SparkSession, folder: str) -> None:
    """Raise unless the folder is as its manifest says."""
    known = json.loads(spark.read.parquet(f"{folder}/{MANIFEST}").first()[0])
    want, found = {tuple(f) for f in known["files"]}, {tuple(r) for r in _files(spark, folder).collect()}
    if want != found:
        changed = sorted({f[0] for f in want ^ found})
        raise ValueError(f"{folder} is not as it was written: {', '.join(changed)}")
    if _schemas(spark, [f for f, _, _ in found], folder) != known["schemas"]:
        raise ValueError(f"{folder} has tables of another schema than it was written with")


def _hadoop(spark: SparkSession, path: str):
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def point_to(spark: SparkSession, path: str, version: str) -> None:
    """Make ``version`` the current one in one step: the pointer is written aside and renamed over the old one."""
    jvm, place, files = _hadoop(spark, path)
    aside, pointer = jvm.org.apache.hadoop.fs.Path(place, f"{POINTER}-{version}"), jvm.org.apache.hadoop.fs.Path(place, POINTER)
    out = files.create(aside, True)
    out.write(bytearray(version.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.makeQualified(place).toUri(), spark._jsc.hadoopConfiguration())
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(files.makeQualified(aside), files.makeQualified(pointer), how)


def current_version(spark: SparkSession, path: str) -> str:
    jvm, place, files = _hadoop(spark, path)
    pointer = jvm.org.apache.hadoop.fs.Path(place, POINTER)
    if not files.exists(pointer):
        raise FileNotFoundError(f"{path} holds no version that was written to the end")
    return spark.read.text(f"{path}/{POINTER}").first()[0]
