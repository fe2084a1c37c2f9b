"""Ingest heterogeneous per-period source files.

Each manifest row names one source file and its provenance (period,
year, quarter, role). A source is read by Spark (csv or parquet), its
headers normalised, the required columns selected by *name* (missing
ones added as null), every cell brought to canonical text with native
expressions, provenance added as literals, and the result written as
one Parquet directory per period. No row passes through Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions.coerce import (canonical_cell_text, canonical_text, canonical_text_of_decimal,
                                       canonical_text_of_integral, canonical_text_of_number)


@dataclass(frozen=True)
class Source:
    period: str
    year: int
    quarter: int
    role: str            # develop | validate | test
    path: str


MANIFEST_SCHEMA = T.StructType([
    T.StructField("period", T.StringType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("quarter", T.IntegerType(), False),
    T.StructField("role", T.StringType(), False),
    T.StructField("path", T.StringType(), False),
])


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def check_manifest(spark: SparkSession, sources: list[Source]) -> None:
    """Fail with the full list of missing sources."""
    missing = [s.path for s in sources if not path_exists(spark, s.path)]
    if missing:
        raise FileNotFoundError(f"sources not found: {missing}")


def normalise_headers(df: DataFrame) -> DataFrame:
    """Strip + upper-case every header; two headers that collide
    after normalisation are an error."""
    new = [str(c).strip().upper() for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"headers {seen[n]!r} and {old!r} both normalise to {n!r}")
        seen[n] = old
    return df.toDF(*new)


def missing_required(df: DataFrame, required: list[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def canonical_cell(df: DataFrame, c: str) -> Column:
    """S4 dispatch on the source type: text cells via the text grammar,
    numeric/boolean cells via the number rules."""
    dt = df.schema[c].dataType
    if isinstance(dt, T.StringType):
        return canonical_text(c)
    if isinstance(dt, T.BooleanType):
        return F.col(c).cast("int").cast("string")
    if isinstance(dt, T.IntegralType):
        return canonical_text_of_integral(c)
    if isinstance(dt, T.DecimalType):
        return canonical_text_of_decimal(c)
    if isinstance(dt, T.NumericType):
        return canonical_text_of_number(c)
    return canonical_text(F.col(c).cast("string"))


def ingest_frame(df: DataFrame, required: list[str], provenance: dict[str, Column]) -> DataFrame:
    """S1 core on one already-read frame: headers, required columns by
    name, canonical text, provenance columns (literals for a file, or
    expressions over normalised source columns for a partitioned source).

    A text cell that is canonical as it came takes one check; any other is
    trimmed once, each cell's grammar apart.
    """
    df = normalise_headers(df)
    have = set(df.columns)
    text = [c for c in required if c in have and isinstance(df.schema[c].dataType, T.StringType)]
    stage = df.select(
        *[F.col(c) for c in required if c in have],
        *[v.alias(f"_prov_{k}") for k, v in provenance.items()])
    cols = []
    for c in required:
        if c in text:
            cols.append(canonical_cell_text(c).alias(c))
        elif c in have:
            cols.append(canonical_cell(df, c).alias(c))
        else:
            cols.append(F.lit(None).cast("string").alias(c))
    cols += [F.col(f"_prov_{k}").alias(k) for k in provenance]
    return stage.select(*cols)


def read_source(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """Read a source; text formats are read with every column as a
    string (no inference), so the text grammar decides numbers."""
    if fmt == "csv":
        return spark.read.option("header", "true").option("inferSchema", "false").csv(path)
    return spark.read.format(fmt).load(path)


def ingest_manifest(spark: SparkSession, sources: list[Source], required: list[str], dest: str,
                    fmt: str = "csv") -> DataFrame:
    """S1 + S6 + S10: ingest every source into ``dest/<period>`` and return
    the load summary (period, source, rows, source_columns,
    missing_required). Row counts come from the written Parquet footers."""
    check_manifest(spark, sources)
    summary = []
    for s in sources:
        df = read_source(spark, s.path, fmt)
        n_cols = len(df.columns)
        absent = missing_required(normalise_headers(df), required)
        out = ingest_frame(df, required, {
            "source": F.lit(s.path.rstrip("/").split("/")[-1]),
            "period": F.lit(s.period),
            "period_year": F.lit(s.year).cast("int"),
            "period_quarter": F.lit(s.quarter).cast("int"),
        })
        target = f"{dest.rstrip('/')}/{s.period}"
        out.write.mode("overwrite").parquet(target)
        rows = spark.read.parquet(target).count()
        summary.append((s.period, s.path.rstrip("/").split("/")[-1], rows, n_cols, ", ".join(absent) or "—"))
    schema = "period string, source string, rows long, source_columns int, missing_required string"
    return spark.createDataFrame(summary, schema)


def read_periods(spark: SparkSession, dest: str, periods: list[str]) -> dict[str, DataFrame]:
    """Per-period map of ingested frames."""
    return {p: spark.read.parquet(f"{dest.rstrip('/')}/{p}") for p in periods}


def load_summary(df: DataFrame, required: list[str], by: str = "period", source_col: str = "source") -> DataFrame:
    """S10 for an already-ingested (or partitioned) source: rows per
    period and source, count of source columns, missing required columns."""
    absent = ", ".join(missing_required(normalise_headers(df), required)) or "—"
    return (df.groupBy(by, source_col).agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("source_columns", F.lit(len(df.columns)).cast("int"))
            .withColumn("missing_required", F.lit(absent)))
