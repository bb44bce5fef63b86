"""Awkward documents that every operator must take."""

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "size bigint, target string, kept string, n_lines string, sequence_id string, class_id string")
LONG = " ".join(f"word{i % 977}" for i in range(20_000))
LINE = "this very line is found in many documents"
ROWS = [
    (1, "a b c d e f g h i j\n" + LINE, "en", "s1"), (2, "x y z\n" + LINE, "en", "s1"), (3, LINE + "\nlast", "en", None),
    (4, None, "en", "s2"), (5, "", None, "s2"), (6, " \t\n ", "de", "s2"), (7, LONG, "en", "s2"),
    (8, "a b c d e f g h i j\n" + LINE, None, "s1"), (None, "no id at all\n" + LINE, None, None), (None, None, None, None),
    (9, "repeated row of words", "de", "s1"), (9, "repeated row of words", "de", "s1"), (10, "é ü ñ 中文字 \U0001F600 text", "fr", "s3"),
]


def awkward(spark, rows=ROWS):
    """The rows, with further columns named like outputs of the operators."""
    return spark.createDataFrame([(*r, 0, -1, "t", "k", "l", "q", "c") for r in rows], SCHEMA)
