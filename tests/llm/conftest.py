import pytest

LONG = "alpha beta gamma delta. " * 3000

ROWS = [
    (1, "One two three four five six seven eight nine ten eleven twelve.\nSecond line here, of a few words.", "en"),
    (2, "One two three four five six seven eight nine ten eleven twelve!\nAnother line; quite its own words.", "en"),
    (3, None, None),
    (4, "", "en"),
    (5, "   \n\t ", "en"),
    (6, LONG, "en"),
    (7, "Ünïcödé wörds, ñ and 日本語 \U0001f642\u200d end <|endoftext|> x", "de"),
    (None, "no id here at all", "en"),
    (8, "twice the same row", "en"),
    (8, "twice the same row", "en"),
    (9, "TWICE the same row", "en"),
    (10, "a@b.co, +1 (555) 123-4567 and 10.0.0.1 or 4111 1111 1111 1111.", "en"),
]

# Columns with names that operators use for their own.
CLASHES = "ids decoded n_tokens score hits items longest n_words part fp node removed n_lines text_key line base rank"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty, very long, repeated and tied rows, and columns with clashing names."""
    rows = [(*r, *(f"keep-{n}" for n in range(len(CLASHES.split())))) for r in ROWS]
    names = ", ".join(f"{c} string" for c in CLASHES.split())
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, {names}")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def small(spark):
    return "/root/testdata/sf0.001"
