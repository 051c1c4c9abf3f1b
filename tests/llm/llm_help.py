"""Small tables for the tests of the training-data operators."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, whole string, key long, TEXT2 string"


def docs_of(spark, texts, parts=3):
    """Rows (index, text) with extra columns, some named like the operators' working columns."""
    rows = [(i, t, "en", "s", len(t or ""), "x", 7, "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(parts)


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict(recursive=True) for r in df.collect()}
