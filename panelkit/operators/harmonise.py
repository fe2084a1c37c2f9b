"""E5: raw text panel -> typed analytic panel (one projection, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.coerce import INTEGER_PATTERN, cell_double, clean_text, is_finite, label
from panelkit.operators.observed import NULLS, PanelObservation
from panelkit.plans.survey import PanelSpec


def parse_stage(df: DataFrame, spec: PanelSpec, extra: list[Column] | None = None) -> DataFrame:
    """First half of the typing: trim the raw ids once and parse the numeric
    cells once (``_t_<raw>`` text, ``_d_<raw>`` double). ``extra`` columns over
    the raw cells pass along."""
    nums = sorted(set(spec.measures.values()) | set(spec.codes.values()))
    return df.select(
        *spec.provenance,
        *[clean_text(r).alias(f"_t_{r}") for r in sorted(set(spec.ids.values()))],
        *[cell_double(r).alias(f"_d_{r}") for r in nums],
        *(extra or []),
    )


def finish_stage(parsed: DataFrame, spec: PanelSpec, kept: list[str] | None = None) -> DataFrame:
    """Second half: ids, measures, whole-number codes, derived columns and
    dictionary labels from the parsed values; ``kept`` columns pass along."""
    cols = [F.col(c) for c in [*spec.provenance, *(kept or [])]]
    cols += [F.when(F.col(f"_t_{raw}").rlike(INTEGER_PATTERN), F.col(f"_t_{raw}").try_cast("bigint")).alias(name)
             for name, raw in spec.ids.items()]
    cols += [F.col(f"_d_{raw}").alias(name) for name, raw in spec.measures.items()]
    cols += [F.when(is_finite(f"_d_{raw}") & (F.col(f"_d_{raw}") == F.rint(f"_d_{raw}")),
                    F.col(f"_d_{raw}").try_cast("int")).alias(name)
             for name, raw in spec.codes.items()]
    typed = parsed.select(*cols)
    if spec.derived:
        typed = typed.withColumns({name: fn() for name, fn in spec.derived.items()})
    if spec.labels:
        typed = typed.withColumns({name: label(code, d) for name, (code, d) in spec.labels.items()})
    return typed


def type_panel(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Type and rename a raw panel.

    ids -> long, measures -> double, codes -> int (all via safe casts),
    then derived columns, then dictionary labels. Provenance columns are
    passed through untouched: the period comes from the source, never from
    the file content.

    Built as stacked projections (ids trimmed and numbers parsed once,
    then codes and labels from the parsed values) so every cell is
    trimmed and parsed a single time; Catalyst does not re-inline the
    non-cheap parse into its several uses, which keeps the generated code
    small enough for whole-stage codegen.
    """
    return finish_stage(parse_stage(df, spec), spec)


def prepare_panel(raw: DataFrame, spec: PanelSpec, rules, path: str, by: str = "period",
                  reason_col: str = "exclusion_reason", observation: PanelObservation | None = None) -> None:
    """E5 + E8 + S7: type, mark and write the panel partitioned by period. An
    ``observation`` takes the cascade's and the missing table's counts on the way.

    The shuffle that clusters rows by period for the write sits between the
    parse and the rest of the typing, so each half is its own code-generated
    stage (one fused stage holding every parse, code, label and rule grows
    past the size the JIT compiles). Its tasks are sized by bytes.
    """
    from panelkit.operators.rules import mark_reasons
    from panelkit.session import shuffles_dropped
    from panelkit.sources.storage import clustered
    extra = [] if observation is None else [observation.null_bits()]
    marked = mark_reasons(finish_stage(clustered(parse_stage(raw, spec, extra), by), spec, [c for c in (NULLS,) if extra]), rules, reason_col)
    if observation is not None:
        marked = observation.attach(marked)
    with shuffles_dropped(raw.sparkSession):
        marked.write.mode("overwrite").partitionBy(by).parquet(path)


def observed_codes(df: DataFrame, code_col: str, label_col: str | None = None) -> DataFrame:
    """A2: observed codes (and labels) with counts, ordered by code, to
    check a dictionary against the data."""
    cols = [code_col] + ([label_col] if label_col else [])
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).orderBy(code_col)
