"""Counts taken while the prepared panel is written: A1 A3 A5 A20 S10 R3
without another scan.

``DataFrame.observe`` adds aggregates to the write itself. They sit after its
shuffle, in the tasks that write: such a task counts once, when it succeeds,
however often it was tried, whereas one before the shuffle counts again if its output is
lost. What only the raw cells know, which of them are null, crosses the
shuffle as one integer of bits for a row.

Rows per period and reason are one histogram: each pair is a number, and
a numeric histogram with at least as many bins as there are numbers is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

NULLS = "_nulls"
REASONS = 64
MAX_CELLS = 4096
MAX_COLUMNS = 62


class PanelObservation:
    """The counts of one write; readable when it has ended. Raises on reading
    if there are more than MAX_CELLS pairs of period and reason."""

    def __init__(self, raw_columns: list[str], rule_names: list[str], by: str = "period", reason: str = "exclusion_reason"):
        if len(raw_columns) > MAX_COLUMNS or len(rule_names) >= REASONS:
            raise ValueError(f"at most {MAX_COLUMNS} columns and {REASONS - 1} rules")
        self.raw_columns, self.rule_names, self.by, self.reason = list(raw_columns), list(rule_names), by, reason
        self._seen = Observation()

    def null_bits(self) -> Column:
        """Bit i is set where raw column i is null."""
        out = F.lit(0).cast("long")
        for i, c in enumerate(self.raw_columns):
            out = out.bitwiseOR(F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
        return out.alias(NULLS)

    def attach(self, marked: DataFrame) -> DataFrame:
        """The marked rows, counted as they pass; the bits go."""
        step = F.lit(len(self.rule_names))
        for i, name in enumerate(self.rule_names):
            step = F.when(F.col(self.reason) == name, F.lit(i)).otherwise(step)
        name = F.coalesce(F.concat(F.lit("="), F.col(self.by).cast("string")), F.lit(""))
        cell = (F.crc32(name.cast("binary")) * REASONS + step).cast("double")
        bit = [F.coalesce(F.sum(F.shiftright(NULLS, i).bitwiseAND(F.lit(1).cast("long"))), F.lit(0)).alias(f"m{i}") for i in range(len(self.raw_columns))]
        return marked.observe(self._seen, F.count(F.lit(1)).alias("rows"), F.collect_set(name).alias("names"),
                              F.histogram_numeric(cell, F.lit(MAX_CELLS)).alias("cells"), *bit).drop(NULLS)

    def counts(self, spark: SparkSession) -> DataFrame:
        """Rows (by, reason, n); a kept row has no reason."""
        import zlib
        seen = self._seen.get
        names = {zlib.crc32(n.encode()): n for n in seen["names"]}
        cells: dict[int, int] = {}
        for c in seen["cells"] or []:
            code = round(c["x"])
            cells[code] = cells.get(code, 0) + round(c["y"])
        if len(names) != len(seen["names"]) or len(cells) >= MAX_CELLS or sum(cells.values()) != seen["rows"]:
            raise ValueError(f"more than {MAX_CELLS} pairs of {self.by} and reason")
        rows = [(names[code // REASONS][1:] or None if names[code // REASONS] else None,
                 self.rule_names[code % REASONS] if code % REASONS < len(self.rule_names) else None, n) for code, n in sorted(cells.items())]
        return spark.createDataFrame(rows, f"{self.by} string, {self.reason} string, n long")

    def missing_table(self, spark: SparkSession, tag: str = "") -> DataFrame:
        """A3 as ``missing.missing_table`` gives it."""
        seen, suffix = self._seen.get, f"_{tag}" if tag else ""
        n = seen["rows"]
        rows = [(c, i, int(seen[f"m{i}"]), 100.0 * seen[f"m{i}"] / n if n else None) for i, c in enumerate(self.raw_columns)]
        return spark.createDataFrame(rows, f"variable string, position int, missing{suffix} long, pct{suffix} double")

    def rows_by(self, spark: SparkSession) -> DataFrame:
        """Rows of each period."""
        return self.counts(spark).groupBy(self.by).agg(F.sum("n").alias("rows"))
