"""Helpers shared by the corpus operators: tables, shared scratch, prefix sums."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: White space that separates words in the word contracts (space, tab to carriage return).
SPACES = r"[\x20\x09-\x0D]+"

_made: dict[str, list[str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor sees.

    Only a local session may do without the setting; it then gets a fresh
    temporary folder. On a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="panelkit-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def _drop(spark: SparkSession, app: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _made.pop(app, []):
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
    except Exception:  # noqa: BLE001  the session may be gone at exit
        pass


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, removed when the program ends."""
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    if app not in _made:
        _made[app] = []
        atexit.register(_drop, spark, app)
    _made[app].append(path)
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read again: cuts
    the lineage with files that outlive a lost executor."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered_rows(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """(the rows with a number each, written once; the number's column)."""
    rid = unused(df, "__rid")
    return saved(df.withColumn(rid, F.monotonically_increasing_id()), name), rid


#: Numbers of rows that may be broadcast (8 bytes each).
MOST_BROADCAST_ROWS = 4_000_000


def without(numbered: DataFrame, gone: DataFrame, rid: str) -> DataFrame:
    """The rows but those whose number is in ``gone`` (a single column ``rid``),
    which is broadcast if it has at most MOST_BROADCAST_ROWS rows."""
    gone = saved(gone, "gone")
    few = gone.count() <= MOST_BROADCAST_ROWS
    return numbered.join(F.broadcast(gone) if few else gone.hint("merge"), rid, "left_anti")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the decimal text of the id, modulo n (a null id counts as empty text)."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def running_total(df: DataFrame, keys: list[str], order: list[str], spread: Column, value: str,
                  out: str, n_rows: int, per_bucket: int = 4096, fan_out: int = 1024) -> DataFrame:
    """Exclusive running sum of ``value`` per ``keys`` as column ``out``.

    The order is (bucket, *order), where the bucket is ``spread`` (a
    non-negative integer that depends on the row's data alone) modulo a count
    that follows ``n_rows``, so that no window, not even one of a key with a
    third of the rows, sorts more than about ``per_bucket`` rows; bucket
    totals are summed over levels of ``fan_out``. Null keys are a group.
    """
    n_buckets = max(1, n_rows // per_bucket)
    b = [f"__{out}{i}" for i in range(12)]
    df = df.withColumn(b[0], (spread % n_buckets).cast("long"))
    here = Window.partitionBy(*keys, b[0]).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn(out, F.coalesce(F.sum(value).over(here), F.lit(0)))
    totals = df.groupBy(*keys, b[0]).agg(F.sum(value).alias("__v"))
    tables, level, count = [], 0, n_buckets
    while True:
        level += 1
        totals = totals.withColumn(b[level], F.floor(F.col(b[level - 1]) / fan_out).cast("long"))
        w = (Window.partitionBy(*keys, b[level]).orderBy(b[level - 1])
             .rowsBetween(Window.unboundedPreceding, -1))
        offs = totals.withColumn("__o", F.coalesce(F.sum("__v").over(w), F.lit(0)))
        tables.append(offs.select(*keys, b[level - 1], F.col(b[level]), "__o"))
        count = -(-count // fan_out)
        if count <= 1:
            break
        totals = totals.groupBy(*keys, b[level]).agg(F.sum("__v").alias("__v"))
    for i, offs in enumerate(tables):
        named = offs.select(*[F.col(k).alias(f"__k{j}") for j, k in enumerate(keys)],
                            F.col(b[i]).alias("__b"), F.col(b[i + 1]), F.col("__o"))
        on = [df[k].eqNullSafe(named[f"__k{j}"]) for j, k in enumerate(keys)] + [df[b[i]] == named["__b"]]
        cond = on[0]
        for c in on[1:]:
            cond = cond & c
        df = (df.join(named, cond).withColumn(out, F.col(out) + F.col("__o"))
              .drop("__b", "__o", *[f"__k{j}" for j in range(len(keys))]))
    return df.drop(*b)


def text_first(documents: DataFrame, carry: list[str]) -> tuple[DataFrame, str]:
    """(the text and the ``carry`` columns, without the text twice; the schema
    of the carried columns). See ``carried``."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*carry).schema)
    return documents.select("text", *[c for c in carry if c != "text"]), schema


def carried(batch, carry: list[str]) -> list:
    """The carried columns of a batch of ``text_first``."""
    return [batch.column(batch.schema.get_field_index(c)) for c in carry]


#: Bytes of text that a task turns into Python objects at a time.
SLICE_BYTES = 4 << 20


def sliced(batches, most_bytes: int):
    """The record batches in slices of not much more than ``most_bytes`` bytes (a row at least)."""
    for b in batches:
        step = max(1, b.num_rows * most_bytes // max(most_bytes, b.nbytes))
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


_held: dict = {}


def held(key, make):
    """What ``make`` gives for ``key``, kept by a Python worker from task to
    task. A worker serves one operator after the other, so it keeps one thing
    only: another key, or ``release``, drops it."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def release() -> None:
    _held.clear()
