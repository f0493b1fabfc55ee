"""Texts that every text operator must take: nulls, empty, long, odd and repeated ones."""

PROSE = "The house stands on the hill and the river runs past it every day of the year. "

CASES = [(1, None), (2, ""), (3, " \n\t\x0b "), (4, PROSE * 3), (4, PROSE * 3), (5, PROSE * 2000), (6, "x"),
         (7, "日本語の文章 です。"), (8, "\x00\x1c\x85 nul and separators"), (None, "no id here"), (9, "1234 5678 ### $$$"),
         (10, "q" * 5000), (11, "½ ² Ⅷ"), (12, "İSTANBUL straße ΣΑΣ ſ")]


def case_frame(spark, **extra):
    """The cases as documents, with extra columns named like results."""
    names = list(extra)
    rows = [(i, t, "en", "src", 0) + tuple(extra.values()) for i, t in CASES]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, schema + "".join(f", {n} string" for n in names))
