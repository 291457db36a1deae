"""Shared rows for the training-data operator tests."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

SF = "/root/testdata/sf0.001"


def docs_of(spark, rows, extra=()):
    """documents from (doc_id, text[, lang[, source]]); ``extra`` names more columns, all filled with 'x'."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    for name in extra:
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)
