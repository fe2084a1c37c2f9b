"""Hand tables for text normalisation and safe casts."""

import math

from pyspark.sql import functions as F

from panelkit.functions.coerce import apart, canonical_from_clean, canonical_text, canonical_text_of_number, is_finite, label, to_code, to_double, to_id
from panelkit.plans.survey import EDUCATION_LABELS


def _one_col(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_canonical_text(spark):
    vals = ["3", "3.0", "3 ", "  ", "1e3", "abc", "nan", "Infinity", "9007199254740993", None, "\t7\n", "1_000", "007"]
    got = [r[0] for r in _one_col(spark, vals).select(canonical_text("v")).collect()]
    assert got == ["3", "3", "3", None, "1000", "abc", "nan", "Infinity", "9007199254740993", None, "7", "1_000", "7"]


def test_canonical_text_of_numbers(spark):
    df = spark.createDataFrame([(3.0,), (3.5,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "v double")
    got = [r[0] for r in df.select(canonical_text_of_number("v")).collect()]
    assert got == ["3", "3.5", None, "Infinity", "-Infinity", None]


def test_safe_double(spark):
    vals = ["3", "3d", "1_000", "3.5", "abc", "nan", "Infinity", "3e10", None, "٣", " -2.5 "]
    got = [r[0] for r in _one_col(spark, vals).select(to_double("v")).collect()]
    assert got[0] == 3.0 and got[1] is None and got[2] is None and got[3] == 3.5 and got[4] is None
    assert math.isnan(got[5]) and got[6] == float("inf") and got[7] == 3e10 and got[8] is None
    assert got[9] is None and got[10] == -2.5


def test_safe_code(spark):
    vals = ["3", "3d", "1_000", "3.5", "abc", "nan", "Infinity", "3e10", None, "4.0"]
    got = [r[0] for r in _one_col(spark, vals).select(to_code("v")).collect()]
    assert got == [3, None, None, None, None, None, None, None, None, 4]


def test_id_to_long(spark):
    vals = ["12", "12.5", "abc", "99999999999999999999", None, " 5 "]
    got = [r[0] for r in _one_col(spark, vals).select(to_id("v")).collect()]
    assert got == [12, None, None, None, None, 5]


def test_labels(spark):
    df = spark.createDataFrame([(0,), (7,), (9,), (None,)], "c int")
    got = [r[0] for r in df.select(label("c", EDUCATION_LABELS)).collect()]
    assert got == ["Ninguno", "Doctorado", "DESCONOCIDO", "DESCONOCIDO"]


def test_is_finite(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "x double")
    got = [r[0] for r in df.select(F.coalesce(is_finite("x"), F.lit(False))).collect()]
    assert got == [True, False, False, False, False]


def test_canonical_text_at_the_edges_of_its_short_check(spark):
    """Text that one check takes for canonical, and text just beside it."""
    vals = ["0", "-0", "+5", "-7", "05", "1.50", "1.5", "+1.5", "-.5", "0.000001", "123456789.000001", "1234567890123456.1", "1e2", "2.", "1.5\n"]
    want = ["0", "0", "5", "-7", "5", "1.50", "1.5", "+1.5", "-.5", "0.000001", "123456789.000001", "1234567890123456", "100", "2", "1.5"]
    got = [r[0] for r in _one_col(spark, vals).select(canonical_text("v")).collect()]
    assert got == want


def test_many_cells_keep_compiled_methods_small(spark):
    """Forty cells' grammars in one projection: no method above the 8000 bytes that are JIT-compiled."""
    import re
    df = _one_col(spark, ["1.0", " x", None]).select(*[F.concat("v", F.lit(str(i % 2))).alias(f"c{i}") for i in range(40)])

    def largest(frame):
        text = spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "codegen")
        return max([int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text)] or [0])
    inline = df.select(*[canonical_from_clean(F.col(c)).alias(c) for c in df.columns])
    cells = df.select(*[apart(canonical_from_clean, c).alias(c) for c in df.columns])
    assert largest(cells) <= 8000 and cells.collect() == inline.collect()


def test_cells_read_as_they_came_are_the_grammars_own(spark):
    """Untrimmed, signed, long, special and non-ASCII cells."""
    from panelkit.functions.coerce import canonical_cell_text, cell_double
    vals = ["0", "7", "-0", "-7", "+7", "07", "1.0", "1.5", "-1.50", "15.0 ", " 3", "3\n", "1.5\n", "\t", "", None, "abc", "nan", "-NaN", "Infinity",
            "-inf", "1e3", "1.", ".5", "1.5d", "0x1", "\u0663", "\u00a07", "123456789012345", "1234567890123456", "123456789012345.123456789012345",
            "9" * 40, "0.1", "1_000", "7\r", "-", "--1", "1.2.3"]
    df = _one_col(spark, vals)
    got = df.select(canonical_cell_text("v").alias("t"), cell_double("v").alias("d")).collect()
    want = df.select(canonical_text("v").alias("t"), to_double("v").alias("d")).collect()
    assert list(map(repr, got)) == list(map(repr, want))


def test_plain_cells_take_no_other_grammar(spark, monkeypatch):
    """A panel of plain cells is ingested and typed without the interpreted rest of the grammar."""
    from panelkit.functions import coerce
    from panelkit.operators.harmonise import parse_stage
    from panelkit.plans.survey import RAW_COLUMNS, SURVEY_SPEC
    from panelkit.sources.ingest import ingest_frame
    monkeypatch.setattr(coerce, "apart", lambda fn, c: F.raise_error(F.lit("other grammar")).cast("string"))
    cells = ["3", "1234567", "-1", "20.5", None]
    raw = spark.createDataFrame([tuple(c for _ in RAW_COLUMNS) for c in cells], ", ".join(f"{c} string" for c in RAW_COLUMNS))
    given = {"source": F.lit("s"), "period": F.lit("2020T1"), "period_year": F.lit(2020), "period_quarter": F.lit(1)}
    ingested = ingest_frame(raw, RAW_COLUMNS, given)
    assert [r["P02A03"] for r in ingested.collect()] == cells
    assert [r["_d_P02A03"] for r in parse_stage(ingested, SURVEY_SPEC).collect()] == [3.0, 1234567.0, -1.0, 20.5, None]


def test_padded_and_zero_fraction_cells_take_no_other_grammar(spark, monkeypatch):
    """Blanks around a canonical cell and a fraction of zeros are taken off without the interpreted rest of the grammar."""
    from panelkit.functions import coerce
    monkeypatch.setattr(coerce, "apart", lambda fn, c: F.raise_error(F.lit("other grammar")).cast("string"))
    vals = ["2.0", " 3 ", " 15.0 ", "-4.", "0.00", " 1.5", "1234"]
    got = [r[0] for r in _one_col(spark, vals).select(coerce.canonical_cell_text("v")).collect()]
    assert got == ["2", "3", "15", "-4", "0", "1.5", "1234"]


def test_short_checks_of_a_cell_agree_with_the_grammar(spark):
    """Cells at the edges of the digit, blank and zero-fraction checks, and numbers that no cast should be asked for."""
    from panelkit.functions.coerce import canonical_cell_text, cell_double
    vals = ["10", "99", "1000", "9999", "10000", "01", "0010", "1a", "12a4", "1 34", "12\u0663", "1\u0663", "\u00e912", "1:", "1/", "-12", "+12", " 12", "12 ",
            "2.0", "2.", "02.0", "-0.0", "+2.0", " 2.0\t", "\t2.0", "2.0 0", "0.0", "-3.000", "2.0\n", " \n 7 ", "1e999", "-1e999", "1E2", "5e-1", "+nan", "NAN",
            "-infinity", "+INF", "nan ", "1\u2028", "12\u2028", "2.0\u2028", "nan\u2028", "1\u0085", "    ", "1234567890.5", "0.0000001", "1.0000000"]
    df = _one_col(spark, vals)
    got = df.select(canonical_cell_text("v").alias("t"), cell_double("v").alias("d")).collect()
    want = df.select(canonical_text("v").alias("t"), to_double("v").alias("d")).collect()
    assert list(map(repr, got)) == list(map(repr, want))
