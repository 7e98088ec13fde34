"""Small tables with the awkward cases every operator has to take."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "text_hash string, node string, h string, n string, bucket string, _source string, token string, score string, pos string")
CLASH = ("x",) * 9


def documents(spark, rows):
    """(doc_id, text, lang, source) rows with n_chars and columns whose names operators use inside."""
    full = [(i, t, la, s, None if t is None else len(t), *CLASH) for i, t, la, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def awkward(spark):
    long_text = " ".join(f"wort{i % 977}" for i in range(60_000))
    return documents(spark, [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", None), (4, "one", None, "a"),
        (5, "the same line\nthe same line\nand more", "en", "b"), (5, "the same line\nthe same line\nand more", "en", "b"),
        (5, "another text of the same id", "en", "b"), (None, "a text without an id", "en", "a"), (None, None, None, None),
        (6, long_text, "de", "b"), (7, long_text + " end", "de", "b"), (8, "\n\n\n", "fr", "c"), (9, "ÄÖÜ É ñ \u2003 x", "de", "c"),
    ])


def empty(spark):
    return documents(spark, [])
