"""Map the TPC-H-style test tables onto the survey's raw person-file
contract, in Spark and (as SQL text) for the DuckDB oracle.

One raw row per lineitem row of an order:

=============  ====================================================
period         year + 'Q' + quarter of o_orderdate (from the source)
NUM_HOGAR      l_orderkey (null for some orders: null keys)
NUM_PERSONA    l_linenumber
FACTOR         o_custkey + 0.5
ANIO/TRIMESTRE year / quarter of o_orderdate (some TRIMESTRE '2.0')
DOMINIO        l_returnflag A/N/R -> '1' / '2.0' / ' 3 '
OCUPADOS       '1' for orders F or O, else null
P02A03 (age)   l_quantity as text, with null / 'abc' / 'nan' /
               'Infinity' / ' 15.0 '-style dirty cells
P03A03A (edu)  l_partkey mod 9 (8 is not in the dictionary)
P05C07A        l_suppkey mod 23 - 1 (tenure years, -1 is invalid)
P05C07B        l_partkey mod 13 (tenure months; 12 and '1.5' invalid)
P05C16         first character of o_orderpriority (5 not salaried)
P05H01A        4 * p_size (hours, above 168 invalid)
P05D01         l_extendedprice as text ('0' for some orders)
=============  ====================================================

Lines of pending orders (status P) are reported twice, as exact copies,
so the duplicate audit sees both exact repeats and conflicts.
The modulo tests only choose *how* a cell is dirtied; every row of the
tables is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEST_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def raw_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw person panel: 14 text columns + 4 provenance columns."""
    l = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag")
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_size")
    # part brings one number, orders four columns: joined last, they cross one shuffle
    j = l.join(p, F.col("l_partkey") == F.col("p_partkey")).join(o, F.col("l_orderkey") == F.col("o_orderkey"))

    # pending-order lines are reported twice: one pass, the copy made by an
    # explode rather than a second join
    j = j.withColumn("_copy", F.explode(
        F.when(F.col("o_orderstatus") == "P", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    k = F.col("l_orderkey")
    yr = F.year("o_orderdate")
    qt = F.quarter("o_orderdate")
    period = F.concat(_s(yr), F.lit("Q"), _s(qt))
    qty = _s(F.col("l_quantity").cast("int"))
    return j.select(
        F.when(k % 101 == 0, F.lit(None).cast("string")).otherwise(_s(k)).alias("NUM_HOGAR"),
        _s(F.col("l_linenumber")).alias("NUM_PERSONA"),
        F.concat(_s(F.col("o_custkey")), F.lit(".5")).alias("FACTOR"),
        _s(yr).alias("ANIO"),
        F.when(k % 53 == 0, F.lit("2.0")).otherwise(_s(qt)).alias("TRIMESTRE"),
        F.when(F.col("l_returnflag") == "A", F.lit("1"))
         .when(F.col("l_returnflag") == "N", F.lit("2.0"))
         .otherwise(F.lit(" 3 ")).alias("DOMINIO"),
        F.when(F.col("o_orderstatus").isin("F", "O"), F.lit("1")).alias("OCUPADOS"),
        F.when(k % 17 == 0, F.lit(None).cast("string"))
         .when(k % 19 == 0, F.lit("abc"))
         .when(k % 23 == 0, F.lit("nan"))
         .when(k % 29 == 0, F.lit("Infinity"))
         .when(k % 31 == 0, F.concat(F.lit(" "), qty, F.lit(".0 ")))
         .otherwise(qty).alias("P02A03"),
        _s(F.col("l_partkey") % 9).alias("P03A03A"),
        _s(F.col("l_suppkey") % 23 - 1).alias("P05C07A"),
        F.when(k % 41 == 0, F.lit("1.5")).otherwise(_s(F.col("l_partkey") % 13)).alias("P05C07B"),
        F.substring("o_orderpriority", 1, 1).alias("P05C16"),
        _s(F.col("p_size") * 4).alias("P05H01A"),
        F.when(k % 37 == 0, F.lit("0")).otherwise(_s(F.col("l_extendedprice"))).alias("P05D01"),
        F.concat(F.lit("orders_"), period, F.lit(".parquet")).alias("source"),
        period.alias("period"),
        yr.cast("int").alias("period_year"),
        qt.cast("int").alias("period_quarter"),
    )


# ---------------------------------------------------------------------------
# The same derivation as DuckDB SQL (used by the oracle).

RAW_SQL = """
raw0 AS (
  SELECT
    CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS NUM_HOGAR,
    CAST(l_linenumber AS VARCHAR) AS NUM_PERSONA,
    CAST(o_custkey AS VARCHAR) || '.5' AS FACTOR,
    CAST(year(o_orderdate) AS VARCHAR) AS ANIO,
    CASE WHEN l_orderkey % 53 = 0 THEN '2.0' ELSE CAST(quarter(o_orderdate) AS VARCHAR) END AS TRIMESTRE,
    CASE WHEN l_returnflag = 'A' THEN '1' WHEN l_returnflag = 'N' THEN '2.0' ELSE ' 3 ' END AS DOMINIO,
    CASE WHEN o_orderstatus IN ('F', 'O') THEN '1' END AS OCUPADOS,
    CASE WHEN l_orderkey % 17 = 0 THEN NULL
         WHEN l_orderkey % 19 = 0 THEN 'abc'
         WHEN l_orderkey % 23 = 0 THEN 'nan'
         WHEN l_orderkey % 29 = 0 THEN 'Infinity'
         WHEN l_orderkey % 31 = 0 THEN ' ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.0 '
         ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS P02A03,
    CAST(l_partkey % 9 AS VARCHAR) AS P03A03A,
    CAST(l_suppkey % 23 - 1 AS VARCHAR) AS P05C07A,
    CASE WHEN l_orderkey % 41 = 0 THEN '1.5' ELSE CAST(l_partkey % 13 AS VARCHAR) END AS P05C07B,
    substr(o_orderpriority, 1, 1) AS P05C16,
    CAST(p_size * 4 AS VARCHAR) AS P05H01A,
    CASE WHEN l_orderkey % 37 = 0 THEN '0' ELSE CAST(l_extendedprice AS VARCHAR) END AS P05D01,
    'orders_' || CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) || '.parquet' AS source,
    CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS period,
    CAST(year(o_orderdate) AS INTEGER) AS period_year,
    CAST(quarter(o_orderdate) AS INTEGER) AS period_quarter,
    o_orderstatus AS _status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
),
raw AS (
  SELECT * EXCLUDE (_status) FROM raw0
  UNION ALL
  SELECT * EXCLUDE (_status) FROM raw0 WHERE _status = 'P'
)"""
