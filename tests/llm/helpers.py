"""Small document tables with the awkward rows every operator must take."""

from pyspark.sql import functions as F

WORDS = "the of and to in is it was for on as with at by from they have this that are".split()


def prose(seed: int, words: int) -> str:
    """Repeatable words with few repeats of runs."""
    out, x = [], seed * 2654435761 % 2**32 + 1
    for _ in range(words):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[x >> 8 & 15] if x >> 20 & 1 else f"w{x >> 10 & 1023:x}")
    return " ".join(out)


SCHEMA = "doc_id long, text string, lang string, row long, digest string, n long, language string"


def awkward(spark):
    """NULLs, empty and blank texts, one long text, ties, repeated rows, and columns whose names operators use."""
    a, b = prose(1, 90), prose(2, 40)
    rows = [
        (1, a, "en"),
        (2, a, "en"),
        (2, a, "en"),
        (3, None, "en"),
        (4, "", None),
        (5, " \n\t", "fr"),
        (None, b, "fr"),
        (None, None, None),
        (6, b + "\n" + b, "fr"),
        (7, "<|endoftext|> é 中 <|im_end|>", "en"),
        (8, prose(3, 20_000), "en"),
        (9, "x" * 3000, "en"),
    ]
    return spark.createDataFrame([(i, t, g, 7, "x", None, "l") for i, t, g in rows], SCHEMA)


#: Names that operators and stages work with.
CLASHES = (
    "quality_score lang_score lang_pred lang_known _number _hits _lang _total _known positions deleted_lines _near_row "
    "_carried component_id row line h rank a.b"
).split()


def clashing(docs):
    """Documents with a column by each of these names, all with one value."""
    return docs.withColumns({c: F.lit(f"own {c}") for c in CLASHES if c not in docs.columns})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
