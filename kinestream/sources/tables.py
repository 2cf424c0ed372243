"""Text tables of recordings: tab-separated tracks with a preamble, wide joint tables, clocks, manifests, NPZ archives."""

from __future__ import annotations

import io
import re
import tarfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinestream.operators.contract import ContractError, enforce


def read_track_text(spark: SparkSession, path: str, key: str, wanted: list[str], sep: str = "\t") -> DataFrame:
    """Rows of text tables that may begin with a preamble: ``key`` as a long, the ``wanted`` columns as doubles, blank as null.

    The header of a file is its line that begins with ``key``; lines before it are passed over. Every file may have an order of columns of its own. Files
    are split like any text, and only the wanted fields are parsed. Raises ContractError for a file without a header or a column.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    split = F.split(F.regexp_replace("value", r"\r$", ""), sep)
    heads = lines.where(F.startswith("value", F.lit(f"{key}{sep}"))).groupBy("file").agg(F.min(split).alias("names"))
    places = [F.array_position("names", c).cast("int").alias(f"_{i}") for i, c in enumerate([key, *wanted])]
    found = lines.select("file").distinct().join(heads, "file", "left").select("file", *places)
    enforce(found.where(" or ".join(f"coalesce(_{i}, 0) = 0" for i in range(len(places)))).select("file"), f"no header or no column of {[key, *wanted]}")
    rows = lines.where(F.regexp_like("value", F.lit(rf"^\s*[0-9]+{sep}"))).select("file", split.alias("p")).join(found, "file")
    field = lambda i: F.nullif(F.trim(F.get("p", F.col(f"_{i}") - 1)), F.lit(""))
    return rows.select(field(0).cast("long").alias(key), *[field(i + 1).cast("double").alias(c) for i, c in enumerate(wanted)])


def read_markers(spark: SparkSession, path: str, markers: list[str], rate: float, key: str = "FrameCounter", unit: str = "mm", sep: str = "\t") -> DataFrame:
    """file, counter and points (a map from marker to struct x, y, z; blank coordinates are null) of marker files.

    The lines before the header are names and values, of which FREQUENCY must be ``rate``. A file that states another or none, or lacks a column of a marker, is a
    ContractError. Files are split like any text.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    parts = F.split(F.regexp_replace("value", r"\r$", ""), sep)
    stated = lines.where(F.startswith("value", F.lit(f"FREQUENCY{sep}"))).groupBy("file").agg(F.max(F.get(parts, F.lit(1))).try_cast("double").alias("rate"), F.min(F.get(parts, F.lit(1))).try_cast("double").alias("least"))
    files = lines.select("file").distinct().join(stated, "file", "left")
    enforce(files.where(f"rate is null or rate != {float(rate)!r} or least != rate"), f"files of another rate than {rate:g}")
    heads = lines.where(F.startswith("value", F.lit(f"{key}{sep}"))).groupBy("file").agg(F.min(parts).alias("names"))
    names = [f"Marker_{m}_Pos_{a}({unit})" for m in markers for a in "XYZ"]
    places = F.array(*[F.array_position("names", c).cast("int") for c in [key, *names]])
    found = files.select("file").join(heads, "file", "left").select("file", places.alias("_at"))
    enforce(found.where("_at is null or array_contains(_at, 0)").select("file"), f"no header, or no column of {names}")
    rows = lines.where(F.regexp_like("value", F.lit(rf"^\s*[0-9]+{sep}"))).select("file", parts.alias("p")).join(found, "file")
    field = lambda i: F.nullif(F.trim(F.get("p", F.get("_at", F.lit(i)) - 1)), F.lit(""))
    points = [x for k, m in enumerate(markers) for x in (F.lit(m), F.struct(*[field(3 * k + j + 1).cast("double").alias(a) for j, a in enumerate("xyz")]))]
    return rows.select("file", field(0).cast("long").alias("counter"), F.create_map(*points).alias("points"))


def joint_rows(wide: DataFrame, key: str, entities: list[str], unit: str = "mm") -> DataFrame:
    """A wide table of ``{entity}_Pos_{X,Y,Z}({unit})`` columns as rows (key, joint, name, x, y, z)."""
    each = [F.struct(F.lit(i).alias("joint"), F.lit(e).alias("name"), *[F.col(f"`{e}_Pos_{a}({unit})`").alias(a.lower()) for a in "XYZ"]) for i, e in enumerate(entities)]
    return wide.select(key, F.inline(F.array(*each)))


def coalesced_aliases(df: DataFrame, name: str, aliases: list[str], most: float) -> DataFrame:
    """``df`` with ``name``: the first known of the aliases; null with ``{name}_conflict`` where known ones differ by more than ``most``."""
    low, high = F.least(*aliases) if len(aliases) > 1 else F.col(aliases[0]), F.greatest(*aliases) if len(aliases) > 1 else F.col(aliases[0])
    conflict = F.coalesce(high - low > most, F.lit(False))
    return df.withColumn(f"{name}_conflict", conflict).withColumn(name, F.when(~conflict, F.coalesce(*aliases)))


def clock_rows(df: DataFrame, stream: list[str], device: str) -> DataFrame:
    """Clock rows without repeated device times: of equal ones the first in the order of all other columns stays."""
    rest = [c for c in df.columns if c not in (*stream, device)]
    w = Window.partitionBy(*stream, device).orderBy(*rest)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def read_npz(spark: SparkSession, path: str, times: str, arrays: list[str]) -> DataFrame:
    """One row for each sample of NPZ archives: path, i, time, and each wanted array's row as a flat array of doubles.

    Pickled content is refused. An archive without one of the arrays gives nulls for it; arrays of another length raise.
    """
    schema = "path string, i long, time double, " + ", ".join(f"`{a}` array<double>" for a in arrays)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for p, raw in zip(f["path"], f["content"], strict=True):
                with np.load(io.BytesIO(bytes(raw)), allow_pickle=False) as z:
                    t = np.asarray(z[times], dtype=float)
                    if t.ndim != 1 or not np.isfinite(t).all() or (np.diff(t) <= 0).any():
                        raise ContractError(f"{p}: times must be finite and increase")
                    out = {"path": p, "i": np.arange(len(t)), "time": t}
                    for a in arrays:
                        v = np.asarray(z[a], dtype=float) if a in z else None
                        if v is not None and len(v) != len(t):
                            raise ContractError(f"{p}: {a} has {len(v)} rows for {len(t)} times")
                        out[a] = [None] * len(t) if v is None else list(v.reshape(len(t), -1))
                    yield pd.DataFrame(out)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, schema)


def read_archived(spark: SparkSession, path: str, ending: str) -> DataFrame:
    """path, name and text of the files in gzipped tar archives whose names end with ``ending``: calibrations that come packed, say.

    An archive is one task, and its members pass through it one after the other; nothing is unpacked to a disk. Members that are no plain files, and names that leave
    the archive's folder, are an error, as is an archive without such a file or with several.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for p, raw in zip(f["path"], f["content"], strict=True):
                found = []
                with tarfile.open(fileobj=io.BytesIO(bytes(raw)), mode="r:gz") as archive:
                    for member in archive:
                        if not member.name.endswith(ending):
                            continue
                        if not member.isfile() or member.name.startswith("/") or ".." in member.name.split("/"):
                            raise ContractError(f"{p}: {member.name} is no plain file below the archive's folder")
                        found.append((p, member.name, archive.extractfile(member).read().decode("utf-8")))
                if len(found) != 1:
                    raise ContractError(f"{p}: {len(found)} files that end with {ending}")
                yield pd.DataFrame(found, columns=["path", "name", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, name string, text string")


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes and SHA-256 of every file below a folder, for joins with a manifest."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def write_once(df: DataFrame, path: str, partition: list[str] | None = None) -> None:
    """Parquet to a new place; an existing one is an error, and the committer's ``_SUCCESS`` comes last."""
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition) if partition else writer).parquet(path)


def write_frame_map(rows: DataFrame, path: str, order: list[str], partition: str) -> None:
    """A frame table as CSV files with a header to a new place, a folder for each ``partition``, rows of a file in ``order``; null is empty."""
    rows.repartition(partition).sortWithinPartitions(partition, *order).write.mode("errorifexists").partitionBy(partition).option("header", True).option("emptyValue", "").csv(path)


def plain_numbers(df: DataFrame) -> DataFrame:
    """``df`` whose floating columns are null where they are not finite: JSON has no such numbers."""
    kinds = dict(df.dtypes)
    return df.select(*[F.when(~F.isnan(c) & (F.abs(c) < float("inf")), F.col(c)).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in df.columns])


def write_metrics(df: DataFrame, path: str) -> None:
    """Rows of metrics as JSON lines with every field named, null for what is not finite, to a new place."""
    plain_numbers(df).write.mode("errorifexists").option("ignoreNullFields", False).json(path)


def publish(spark: SparkSession, tables: dict[str, DataFrame], path: str, metrics: DataFrame) -> None:
    """Tables to a new place, then the sorted list of their files' hashes, then the metrics: where there are metrics, all else is whole."""
    for name, df in tables.items():
        write_once(df, f"{path}/{name}")
    checksums(spark, [f"{path}/{n}" for n in tables], path).coalesce(1).write.mode("errorifexists").text(f"{path}/SHA256SUMS")
    write_metrics(metrics, f"{path}/metrics")


def checksums(spark: SparkSession, folders: list[str], below: str) -> DataFrame:
    """value: the lines of a checksum list, hash, two spaces, path below ``below``, in the order of paths. One line for each file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
    name = F.regexp_replace("path", rf"^.*?{re.escape(below.rstrip('/'))}/", "")
    return files.select(F.sha2("content", 256).alias("h"), name.alias("n")).orderBy("n").select(F.concat("h", F.lit("  "), "n").alias("value"))


def found_segments(spark: SparkSession, root: str, prefixes: list[str]) -> dict[str, str]:
    """The one folder below ``root`` that begins with each prefix; none or several are a ContractError."""
    base = spark._jvm.org.apache.hadoop.fs.Path(root)
    names = sorted(f.getPath().getName() for f in base.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(base) if f.isDirectory())
    found = {p: [n for n in names if n.startswith(p)] for p in prefixes}
    if wrong := {p: n for p, n in found.items() if len(n) != 1}:
        raise ContractError(f"{root}: one folder for each prefix is needed, not {wrong}")
    return {p: f"{root.rstrip('/')}/{n[0]}" for p, n in found.items()}


def append_log(df: DataFrame, path: str) -> None:
    """Rows as JSON lines behind those that are there."""
    plain_numbers(df).write.mode("append").option("ignoreNullFields", False).json(path)
