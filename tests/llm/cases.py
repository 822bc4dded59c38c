"""Documents with every awkward case, and brute-force versions of the operators."""

import re

import duckdb
from pyspark.sql import types as T

WORD = re.compile(rb"[^\x20\x09-\x0D]+")

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("size", T.StringType()), T.StructField("KEPT", T.LongType()),
    T.StructField("c0", T.StringType()), T.StructField("row", T.LongType()),
    T.StructField("fp", T.LongType()), T.StructField("copies", T.LongType())])


def document(doc_id, text, lang="en", source="s1"):
    return (doc_id, text, lang, source, None, "x", 1, "y", 2, 3, 4)


def plain(n, word="w"):
    return " ".join(f"{word}{i}" for i in range(n))


def awkward(spark):
    """Nulls in every column, empty and long texts, ties and rows repeated whole."""
    long = "\n".join(plain(500, f"l{k}x") for k in range(120))
    rows = [
        document(1, plain(60)), document(1, plain(60)), document(2, plain(60)),
        document(3, None), document(4, ""), document(5, " \t\n "), document(6, "\n\n"),
        document(7, long), document(None, plain(70, "q")), document(None, None, None, None),
        document(8, plain(80, "é"), None, None), document(9, "Ünï " * 60, "de", "s2"),
        document(10, "one two three", "fr", "s2"), document(11, "### *** $$$ " * 30, "en", ""),
        document(12, plain(60) + "\n" + plain(60), "en", "s3"), (None,) * len(DOCS),
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def words(text):
    return WORD.findall((text or "").encode())


def lower(data):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in data)


def in_duckdb(sql, **tables):
    """Rows of a query over pandas tables, sorted as text."""
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame)
    return con.execute(sql).df()


def sorted_rows(frame, columns):
    plain_rows = frame[columns].astype(object).where(frame[columns].notna(), None)
    return sorted(map(str, plain_rows.values.tolist()))


def same_rows(spark_frame, frame):
    mine = spark_frame.toPandas()
    columns = sorted(mine.columns)
    assert columns == sorted(frame.columns)
    for c in columns:  # whole numbers stay whole beside nulls
        if mine[c].dtype == float and (mine[c].dropna() % 1 == 0).all() and frame[c].dtype != float:
            mine[c] = mine[c].astype("Int64")
    assert sorted_rows(mine, columns) == sorted_rows(frame, columns)
