"""DuckDB SQL building blocks for the correctness oracle.

The oracle re-states each step independently in SQL: the same number
grammar, the same rule order, the same dictionaries. Queries are built
as one WITH chain: raw -> typed -> marked -> kept -> ...
"""

from __future__ import annotations

from panelkit.plans.survey import SURVEY_SPEC
from panelkit.plans.testpanel import RAW_SQL

# The grammars and the fallback label, stated here once more so that a slip in
# the code under test is not shared by its oracle.
NUMBER_PATTERN = r"^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[+-]?(?i:nan|inf|infinity))$"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
UNKNOWN_LABEL = "DESCONOCIDO"


def sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def clean(c: str) -> str:
    ws = "chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"
    return f"NULLIF(trim({c}, {ws}), '')"


def to_double(c: str) -> str:
    s = clean(c)
    return f"(CASE WHEN regexp_matches({s}, {sql_str(NUMBER_PATTERN)}) THEN TRY_CAST({s} AS DOUBLE) END)"


def finite(x: str) -> str:
    return f"({x} IS NOT NULL AND isfinite({x}))"


def to_code(c: str) -> str:
    d = to_double(c)
    return f"(CASE WHEN {finite(d)} AND {d} = floor({d}) THEN TRY_CAST({d} AS INTEGER) END)"


def to_id(c: str) -> str:
    s = clean(c)
    return f"(CASE WHEN regexp_matches({s}, {sql_str(INTEGER_PATTERN)}) THEN TRY_CAST({s} AS BIGINT) END)"


def label(code: str, d: dict[int, str]) -> str:
    whens = " ".join(f"WHEN {code} = {k} THEN {sql_str(v)}" for k, v in d.items())
    return f"(CASE {whens} ELSE {sql_str(UNKNOWN_LABEL)} END)"


def canonical(c: str) -> str:
    """S4 in SQL: canonical text of a raw cell."""
    s = clean(c)
    d = to_double(c)
    dec_s = f"TRY_CAST({s} AS DECIMAL(38,0))"
    dec_d = f"TRY_CAST({d} AS DECIMAL(38,0))"
    return (f"(CASE WHEN {s} IS NULL THEN NULL "
            f"WHEN regexp_matches({s}, {sql_str(INTEGER_PATTERN)}) AND {dec_s} IS NOT NULL THEN CAST({dec_s} AS VARCHAR) "
            f"WHEN {finite(d)} AND {d} = floor({d}) AND {dec_d} IS NOT NULL THEN CAST({dec_d} AS VARCHAR) "
            f"ELSE {s} END)")


def canon_cte(src: str = "raw") -> str:
    """The ingested raw store: every required column as canonical text."""
    cols = [f"{canonical(c)} AS {c}" for c in SURVEY_SPEC.raw_columns] + list(SURVEY_SPEC.provenance)
    return f"canon AS (SELECT {', '.join(cols)} FROM {src})"


def typed_cte(src: str = "canon") -> str:
    spec = SURVEY_SPEC
    cols = list(spec.provenance)
    cols += [f"{to_id(raw)} AS {n}" for n, raw in spec.ids.items()]
    cols += [f"{to_double(raw)} AS {n}" for n, raw in spec.measures.items()]
    cols += [f"{to_code(raw)} AS {n}" for n, raw in spec.codes.items()]
    base = f"typed0 AS (SELECT {', '.join(cols)} FROM {src})"
    labels = [f"{label(code, d)} AS {n}" for n, (code, d) in spec.labels.items()]
    typed = (f"typed AS (SELECT *, tenure_years + tenure_months / 12.0 AS tenure, "
             f"{', '.join(labels)} FROM typed0)")
    return base + ",\n" + typed


# Rules restated in SQL, same order as survey_rules().
RULES_SQL = [
    ("1_age_under_15_or_invalid", "isfinite(age) AND age >= 15"),
    ("2_not_employed", "employed = 1"),
    ("3_not_salaried", "category_code IN (1, 2, 3, 4)"),
    ("4_wage_missing_or_not_positive", "isfinite(wage) AND wage > 0"),
    ("5_tenure_years_invalid", "isfinite(tenure_years) AND tenure_years >= 0"),
    ("6_tenure_months_invalid",
     "isfinite(tenure_months) AND tenure_months = floor(tenure_months) AND tenure_months BETWEEN 0 AND 11"),
    ("7_tenure_exceeds_age", "tenure <= age"),
    ("8_hours_out_of_range", "isfinite(hours) AND hours > 0 AND hours <= 168"),
]


def marked_cte(src: str = "typed") -> str:
    whens = " ".join(f"WHEN NOT coalesce({cond}, false) THEN {sql_str(n)}" for n, cond in RULES_SQL)
    return f"marked AS (SELECT *, CASE {whens} ELSE NULL END AS exclusion_reason FROM {src})"


KEPT_CTE = "kept AS (SELECT * FROM marked WHERE exclusion_reason IS NULL)"


def base_chain(upto: str = "kept") -> str:
    parts = [RAW_SQL.strip()]  # upto: raw < canon < typed < marked < kept
    if upto in ("canon", "typed", "marked", "kept"):
        parts.append(canon_cte())
    if upto in ("typed", "marked", "kept"):
        parts.append(typed_cte())
    if upto in ("marked", "kept"):
        parts.append(marked_cte())
    if upto == "kept":
        parts.append(KEPT_CTE)
    return ",\n".join(parts)


def with_chain(*ctes: str, upto: str = "kept", final: str) -> str:
    parts = [base_chain(upto)] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + final.strip()
