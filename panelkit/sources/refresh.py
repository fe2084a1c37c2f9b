"""Ingest of many files in a few scans, and of re-delivered quarters alone
(S1 S5 S7 S9 S10).

Files of equal headers are read in one scan; ``_metadata.file_path`` tells
their rows apart and is joined with the manifest for the provenance, so the
number of jobs depends on the number of different headers, not of files. The store
is partitioned by period; beside it lies a manifest with a digest of each
file's content. A later call reads all files for their digests, but parses and
rewrites only the periods of which a file has changed, come or gone, by dynamic
partition overwrite.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.joins import checked_join, cut
from panelkit.sources.ingest import Source, check_manifest, ingest_frame, path_exists

MANIFEST = "path string, period string, year int, quarter int, role string"
_FILE = "__file"


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _uri(path: Column) -> Column:
    """A file's address with one slash after the scheme, as both sides of the join have it."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def file_uri(spark: SparkSession, path: str) -> str:
    """The full address of a path, escaped as in ``_metadata.file_path``."""
    p, fs = _hadoop(spark, path)
    scheme, rest = fs.makeQualified(p).toUri().toString().split(":", 1)
    return f"{scheme}:/{rest.lstrip('/')}"


def header(spark: SparkSession, path: str, fmt: str) -> tuple[str, ...]:
    """Column names of a file, without a job: the first line of a csv file (compressed
    as its ending says), the footer of a Parquet one."""
    if fmt != "csv":
        return tuple(spark.read.format(fmt).load(path).columns)
    p, fs = _hadoop(spark, path)
    jvm = spark.sparkContext._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(p)
    stream = fs.open(p) if codec is None else codec.createInputStream(fs.open(p))
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    return tuple(next(csv.reader([line.lstrip("﻿")]))) if line else ()


def _read(spark: SparkSession, paths: list[str], names: tuple[str, ...], fmt: str) -> DataFrame:
    """All files of one header with the column ``__file``; csv cells are text."""
    if fmt == "csv":
        schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in names)
        df = spark.read.option("header", "true").schema(schema).csv(paths)
    else:
        df = spark.read.format(fmt).load(paths)
    return df.select("*", _uri(F.col("_metadata.file_path")).alias(_FILE))


def by_header(spark: SparkSession, sources: list[Source], fmt: str) -> dict[tuple[str, ...], list[Source]]:
    groups: dict[tuple[str, ...], list[Source]] = {}
    for s in sources:
        groups.setdefault(header(spark, s.path, fmt), []).append(s)
    return groups


def file_digests(spark: SparkSession, sources: list[Source], fmt: str = "csv") -> DataFrame:
    """Rows (file, digest, rows): a digest of the rows' content, whatever
    their order, one scan for each header. A file without rows has none."""
    out = None
    for names, group in by_header(spark, sources, fmt).items():
        df = _read(spark, [s.path for s in group], names, fmt)
        cells = [F.col(f"`{c}`") for c in df.columns if c != _FILE]
        h = F.xxhash64(F.lit("|".join(names)), *[x for c in cells for x in (c, c.isNull())])
        one = df.select(F.col(_FILE).alias("file"), h.alias("h")).groupBy("file").agg(
            F.count(F.lit(1)).alias("rows"), F.bit_xor("h").alias("x"), F.sum(F.pmod("h", F.lit(1 << 31))).alias("s"))
        one = one.select("file", F.concat_ws("-", F.hex("x"), F.hex("s"), F.hex("rows")).alias("digest"), "rows")
        out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], "file string, digest string, rows long")


def ingest_files(spark: SparkSession, sources: list[Source], required: list[str], fmt: str = "csv") -> DataFrame:
    """The canonical rows of all files, with source, period, year and
    quarter from the manifest: a scan for each header, a join for the provenance."""
    check_manifest(spark, sources)
    rows = [(file_uri(spark, s.path), s.period, s.year, s.quarter, s.path.rstrip("/").split("/")[-1]) for s in sources]
    manifest = spark.createDataFrame(rows, f"{_FILE} string, __period string, __year int, __quarter int, __source string")
    out = None
    for names, group in by_header(spark, sources, fmt).items():
        df = checked_join(_read(spark, [s.path for s in group], names, fmt), manifest, _FILE)
        one = ingest_frame(df, required, {"source": F.col("__SOURCE"), "period": F.col("__PERIOD"), "period_year": F.col("__YEAR"),
                                          "period_quarter": F.col("__QUARTER")})
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no sources")
    return out


@dataclass(frozen=True)
class Refresh:
    """What a call rewrote, what it left, and periods of the store without any source now."""

    rewritten: list[str]
    unchanged: list[str]
    orphaned: list[str]


def refresh(spark: SparkSession, sources: list[Source], required: list[str], dest: str, fmt: str = "csv") -> Refresh:
    """Brings the store at ``dest`` (partitions under ``rows``, the manifest
    under ``manifest``) up to the files. The manifest is written last, so a call
    that was cut short is repeated by the next one. Orphaned periods are reported and kept."""
    base = dest.rstrip("/")
    check_manifest(spark, sources)
    digests = {r["file"]: r["digest"] for r in file_digests(spark, sources, fmt).collect()}  # a row for each file of the manifest
    now = {}
    for s in sources:
        now.setdefault(s.period, set()).add((file_uri(spark, s.path), digests.get(file_uri(spark, s.path), "")))
    before: dict[str, set[tuple[str, str]]] = {}
    if path_exists(spark, f"{base}/manifest"):
        for r in spark.read.parquet(f"{base}/manifest").collect():
            before.setdefault(r["period"], set()).add((r["file"], r["digest"]))
    changed = sorted(p for p, files in now.items() if before.get(p) != files)
    if changed:
        rows = ingest_files(spark, [s for s in sources if s.period in set(changed)], required, fmt)
        # a file has one period, so a task meets few: the store has no more files than its sources have splits, without a shuffle
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("period").parquet(f"{base}/rows"))
        kept = {p: files for p, files in before.items() if p not in now}
        listed = [(p, f, d) for p, files in {**now, **kept}.items() for f, d in sorted(files)]
        spark.createDataFrame(listed, "period string, file string, digest string").coalesce(1).write.mode("overwrite").parquet(f"{base}/manifest")
    return Refresh(changed, sorted(set(now) - set(changed)), sorted(set(before) - set(now)))


def stored(spark: SparkSession, dest: str) -> DataFrame:
    return spark.read.parquet(f"{dest.rstrip('/')}/rows")


def load_report(spark: SparkSession, sources: list[Source], required: list[str], dest: str, fmt: str = "csv") -> DataFrame:
    """S10 of the store: (period, source, rows, source_columns, missing_required)."""
    about = []
    for names, group in by_header(spark, sources, fmt).items():
        have = {n.strip().upper() for n in names}
        absent = ", ".join(sorted(set(required) - have)) or "—"
        about += [(s.period, s.path.rstrip("/").split("/")[-1], len(names), absent) for s in group]
    listed = cut(spark.createDataFrame(about, "period string, source string, source_columns int, missing_required string"))
    rows = stored(spark, dest).groupBy(F.col("period").cast("string").alias("period"), "source").agg(F.count(F.lit(1)).alias("rows"))
    return listed.join(rows, ["period", "source"], "left").fillna(0, ["rows"]).select("period", "source", "rows", "source_columns", "missing_required")
