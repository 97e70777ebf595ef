"""Rows with the odd cases every operator has to take."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, first=0):
    """A documents table of these texts, numbered from first."""
    rows = [(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)
