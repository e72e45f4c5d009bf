"""Small tables for the operator tests."""

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, extra=False):
    """Documents 0, 1, ... of these texts; ``extra`` adds columns whose names clash with internal ones."""
    rows = [(k if not isinstance(t, tuple) else t[0], t if not isinstance(t, tuple) else t[1], "en", "s", None) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, DOCS)
    if extra:
        for name in ("row", "line", "digest", "salt", "cls", "node", "keep", "a", "b", "kept", "length", "trusted", "body"):
            frame = frame.selectExpr("*", f"'x' AS {name}")
    return frame
