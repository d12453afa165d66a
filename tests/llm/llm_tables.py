"""Small tables of documents for the tests."""

#: Columns of documents, then ones named like what operators use or add.
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "size string, shard string, kept string, n_words string, spans string, p string, u string, pack string, key string, "
        "n_tokens string, fingerprint string, positions string, n_lines string")
CLASHING = DOCS.count(",") - 4


def make_docs(spark, rows):
    """Rows are (doc_id, text, lang, source); the clashing columns hold marks."""
    return spark.createDataFrame(
        [(i, t, lang, s, None if t is None else len(t), *["x"] * CLASHING) for i, t, lang, s in rows], DOCS)
