"""Documents with every odd case: nulls, empty and long texts, repeated rows, clashing names."""

LONG = "Lorem ipsum dolor " * 40000

ODD_TEXTS = [
    (1, "The cat sat on the mat."),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b\x0c\r "),
    (5, "x"),
    (6, "Größe naïve ÉCOLE 北京大学 🙂 é"),
    (7, LONG),
    (8, "The cat sat on the mat."),
    (8, "The cat sat on the mat."),
    (None, "no id here"),
    (9, "a" * 5000),
    (10, "1234567890 !!! ??? <|endoftext|> it's we'll"),
]


def odd_documents(spark, rows=ODD_TEXTS):
    """The rows with extra columns named as the operators name theirs."""
    return spark.createDataFrame(
        [(i, t, None if n % 3 == 0 else "en", f"s{n % 2}", 7, "x", 1) for n, (i, t) in enumerate(rows)],
        "doc_id long, text string, lang string, source string, component_id long, "
        "fingerprint string, n_tokens int",
    )
