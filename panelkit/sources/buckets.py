"""A panel stored in buckets of its key, so that key audits, semi joins and
flag joins need no further shuffle of it.

A bucket is read by one task, so what cannot be dealt evenly stays out of the
buckets, in a plain part: rows with a null key part, and rows of hot keys (more than
``hot_rows`` rows each; there are at most rows / hot_rows of them, which bounds their
broadcast). The two parts share no key, so answers about keys are the union of both parts'.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.joins import cut
from panelkit.operators.keys import any_null
from panelkit.session import shuffles_dropped

ROWS_A_BUCKET = 1_000_000
#: Cells of the keys' hash in which rows are counted before any key is.
CELLS = 1 << 16


@dataclass(frozen=True)
class KeyStore:
    """``bucketed``: rows with complete, ordinary keys; ``plain``: all others."""

    key: list[str]
    buckets: int
    bucketed: DataFrame
    plain: DataFrame

    def rows(self) -> DataFrame:
        return self.bucketed.unionByName(self.plain)


def bucket_count(rows: int, shuffle_partitions: int, rows_a_bucket: int = ROWS_A_BUCKET) -> int:
    """Buckets that follow the rows; one for each shuffle partition at least."""
    return max(shuffle_partitions, -(-rows // rows_a_bucket), 1)


def write_key_store(df: DataFrame, key: list[str], path: str, buckets: int | None = None,
                    hot_rows: int = ROWS_A_BUCKET) -> KeyStore:
    """Writes ``df`` (read three times: counts, buckets, plain part) to ``path``.
    Stores that are to be joined without a shuffle need the same ``buckets``."""
    spark = df.sparkSession
    complete = df.where(~any_null(key))
    # combined map-side: a hot key's cell of the hash holds more than hot_rows rows too, so only rows of such cells are counted by key
    cell = F.pmod(F.xxhash64(*key), F.lit(CELLS)).alias("_cell")
    cells = cut(complete.groupBy(cell).agg(F.count(F.lit(1)).alias("_n")))
    full = cells.where(F.col("_n") > hot_rows).select("_cell")
    with shuffles_dropped(spark):
        found = cells.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count(F.when(F.col("_n") > hot_rows, 1)).alias("full")).first()
    rows = found["rows"]
    n = buckets or bucket_count(rows, int(spark.conf.get("spark.sql.shuffle.partitions")))
    base = path.rstrip("/")
    plain = df.where(any_null(key))
    if found["full"]:
        some = complete.select(*key, cell).join(F.broadcast(full), "_cell", "left_semi")
        hot = F.broadcast(cut(some.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select(*key)))
        plain = plain.unionByName(complete.join(hot, key, "left_semi"))
        complete = complete.join(hot, key, "left_anti")
    name = _table(base)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    with shuffles_dropped(spark):
        plain.write.mode("overwrite").parquet(f"{base}/plain")
        # dealt by the buckets' own hash, so a task writes one file of one bucket
        (complete.repartition(n, *key).write.mode("overwrite").format("parquet").bucketBy(n, key[0], *key[1:]).sortBy(key[0], *key[1:])
         .option("path", f"{base}/bucketed").saveAsTable(name))
    spark.createDataFrame([(key, n)], "key array<string>, buckets int").coalesce(1).write.mode("overwrite").parquet(f"{base}/about")
    return KeyStore(list(key), n, spark.table(name), spark.read.schema(df.schema).parquet(f"{base}/plain"))


def open_key_store(spark: SparkSession, path: str) -> KeyStore:
    """A store written earlier, also by another session: the table is declared anew over its files."""
    base = path.rstrip("/")
    about = spark.read.parquet(f"{base}/about").first()
    key, n = list(about["key"]), about["buckets"]
    files = spark.read.parquet(f"{base}/bucketed")
    name = _table(base)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)
        by = ", ".join(f"`{c}`" for c in key)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {n} BUCKETS LOCATION '{base}/bucketed'")
    return KeyStore(key, n, spark.table(name), spark.read.schema(files.schema).parquet(f"{base}/plain"))


def _table(base: str) -> str:
    return f"key_store_{hashlib.md5(base.encode()).hexdigest()}"
