"""Tables with the awkward rows that every operator must take."""

import duckdb

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of hill river stone cloud walk under green seven lamp door paper night field over quiet".split()


def words(n, seed=0):
    """n words, different for each seed."""
    x, out = seed * 7919 + 1, []
    for _ in range(n):
        x = (x * 48271 + 11) % 2147483647
        out.append(WORDS[x % len(WORDS)] + (WORDS[(x // 31) % len(WORDS)] if x % 3 else ""))
    return " ".join(out)


def awkward():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long = words(30_000, 3)
    rows = [(1, words(60, 1), "en", "a"), (1, words(60, 1), "en", "a"), (2, words(60, 1), "en", None), (3, None, "en", "b"),
            (4, "", "en", "b"), (5, " \n\t ", None, "a"), (None, words(40, 2), "fr", "c"), (None, None, None, None),
            (6, long, "en", "a"), (7, "12345 67 !!", "en", "b"), (8, "one", "fr", "c"), (9, "É Ç ß K İ 漢字 words", "fr", "c"),
            (1, words(50, 5), "fr", "d"), (10, words(60, 1).upper(), "en", "b"), (-3, words(20, 9), "", "")]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


def documents(spark, rows=None, clashing=True):
    df = spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)
    if clashing:
        for c in ("rid", "fp", "key", "size", "w", "raw", "n_words", "score", "y", "label", "block", "item_id", "spans", "n"):
            df = df.withColumn(c, F.lit("x"))
    return df


def duck(sql, **tables):
    con = duckdb.connect()
    for name, path in tables.items():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    res = con.execute(sql)
    return [d[0] for d in res.description], res.fetchall()


def same(df, sql, **tables):
    """Spark's rows are those of the SQL over the same Parquet files."""
    cols, rows = duck(sql, **tables)
    assert sorted(df.columns) == sorted(cols)
    got = [tuple(r[c] for c in cols) for r in df.collect()]

    def norm(rs):
        return sorted(tuple(f"{v:.9g}" if isinstance(v, float) else repr(v) for v in r) for r in rs)
    assert norm(got) == norm(rows)


def written(df, folder, name):
    path = f"{folder}/{name}.parquet"
    df.coalesce(1).write.parquet(path)
    return path
