import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Hand-made rows: nulls, empty and long texts, ties, repeated rows, and a column with a clashing name."""
    base = "the quick brown fox jumps over the lazy dog and runs far away from here today"
    long = " ".join(f"w{i % 97}x{i % 89}" for i in range(30_000))
    rows = [
        (0, base), (1, base), (2, base.replace(" ", "\n")), (3, base + " again"), (4, None), (5, ""), (6, " \t\n"), (7, "two words"),
        (8, "Two  WORDS"), (9, long), (10, long + " tail"), (11, "naïve Ünïcode — ΣΑΣ 日本語 <|endoftext|> don't"), (11, "same id, other text"),
        (12, base), (12, base), (None, base), (None, None), (13, "x" * 5000),
    ]
    return spark.createDataFrame([(i, t, "en" if i != 3 else None, f"src{(i or 0) % 3}" if i != 7 else None, i) for i, t in rows], "doc_id long, text string, lang string, source string, id long")


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.limit(0)
