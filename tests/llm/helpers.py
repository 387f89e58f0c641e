"""Small fixtures and brute-force versions shared by the tests."""

import re
from collections import Counter

import duckdb

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}

LONG = "lorem ipsum dolor sit amet consectetur " * 4000
NOTE = "one two three four five six seven eight nine ten eleven twelve"

#: Nulls in every column, empty and very long texts, ties, repeated rows, copies apart from white space.
ROWS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta. " + NOTE, "en", "a"),
    (2, "Alpha beta gamma delta epsilon zeta eta theta. " + NOTE, "en", "a"),
    (2, "Alpha beta gamma delta epsilon zeta eta theta. " + NOTE, "en", "a"),
    (3, "Alpha  beta gamma\tdelta epsilon zeta eta theta.\n" + NOTE, "en", None),
    (4, None, None, None),
    (5, "", "de", "b"),
    (6, " \t\n", "de", "b"),
    (7, LONG, "la", "b"),
    (8, "ÄÖ ß été 中文 😀 x", None, "c"),
    (9, "12 34 !!", "en", "é"),
    (None, "No id here but words enough to make a few shingles of five", "en", "a"),
    (None, None, None, None),
    (10, "short text", "en", "c"),
    (11, "short text", "fr", "c"),
]


def documents(spark, rows=ROWS):
    """doc_id, text, lang, source, n_chars, and columns whose names may clash with an operator's own."""
    full = [(i, t, lang, s, None if t is None else len(t), 7, "x", 1.5, "y", True) for i, t, lang, s in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, size long, "
                                       "key string, score double, _score string, kept boolean")


def parquet(spark, df, tmp_path, name="documents"):
    path = str(tmp_path / f"{name}.parquet")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def rows_of(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect()) if columns else Counter(tuple(r) for r in df.collect())


def duck(sql, **tables):
    """Rows of a statement over parquet folders, as a multiset of dicts' items in column order."""
    con = duckdb.connect()
    for name, path in tables.items():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/{name}.parquet/*.parquet')")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return names, Counter(cursor.fetchall())


def same_as_sql(df, sql, tmp_path, *tables):
    names, want = duck(sql, **{t: tmp_path for t in tables})
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df, *names) == want
