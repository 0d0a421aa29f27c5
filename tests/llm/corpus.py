"""Small awkward tables for the corpus operators, and brute-force versions."""

import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long, FP string, _hash long, H int"


def awkward_documents(spark, extra=()):
    """Null fields, empty and wordless texts, a long text, ties, repeated rows, clashing names."""
    near = [f"w{i}" for i in range(300)]
    changed = [*near[:150], "other", *near[151:]]
    rows = [
        (1, " ".join(near), "en", "a", 1, "x", 5, 1),
        (2, " ".join(near), "en", "a", 1, None, 5, 1),
        (2, " ".join(near), "en", "a", 1, None, 5, 1),
        (3, " ".join(changed), None, "b", None, "x", None, None),
        (4, "", "en", None, 0, "", 0, 0),
        (5, None, "en", None, None, None, None, None),
        (6, " \t\r\n", "en", "b", 4, "y", 1, 1),
        (7, "one two", "en", "b", 7, "y", 1, 1),
        (8, "ONE two", "en", "b", 7, "y", 1, 1),
        (None, "one two", "en", "b", 7, "y", 1, 1),
        (None, None, None, None, None, None, None, None),
        (9, "long words " * 20_000, "en", "c", 1, "y", 1, 1),
        (10, "São Paulo <|endoftext|> ünï😀", "pt", "c", 1, "y", 1, 1),
        *extra,
    ]
    return spark.createDataFrame(rows, DOCS)


def no_documents(spark):
    return spark.createDataFrame([], DOCS)


def fold(key, folds):
    return zlib.crc32(str(key).encode()) % folds
