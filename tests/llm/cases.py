"""Small document tables with the awkward cases every operator must stand."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, size int, score double, digest string"


def frame(spark, rows):
    """rows: (doc_id, text[, source]) with extra columns whose names clash with operators' own."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 1, "f", 3, 0.5, "d") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


WORDS = "the of lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt labore magna".split()

AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one"),
    (5, "one  two"),
    (6, "one\ntwo"),
    (6, "one\ntwo"),
    (None, "one two"),
    (None, "lonely text without an id"),
    (8, "Grüße aus Zürich, naïve Ångström     ß"),
    (9, " ".join(WORDS[i * i % len(WORDS)] for i in range(30_000))),
    (10, "ONE two", None),
    (11, "tail \U0001f600 emoji", None),
]
