import os

import pytest

SMALL = os.getenv("TEST_SF_DIR", "/root/testdata/sf0.001")

# Names that operators use inside; a table may have columns of these names as well.
CLASHING = (
    "row_key score predicted rest words n_words line leaf kept gone n_lines bucket pair cells "
    "set_class root keeper other_key contaminated_key"
).split()


def odd_rows():
    """Rows with NULLs, empty and repeated texts and ids."""
    return [
        (1, "a plain text of some words, not long at all"),
        (2, ""),
        (3, None),
        (None, "a text without an id, and with some words in it"),
        (None, None),
        (4, "   \n\n \t "),
        (5, "word"),
        (6, "a plain text of some words, not long at all"),
        (6, "a plain text of some words, not long at all"),
        (7, "x" * 50_000),
        (8, "many words " * 20_000),
        (9, "ends here.\n\nSecond line 2024\n> quoted"),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """`odd_rows` with further columns of clashing names."""
    frame = spark.createDataFrame(odd_rows(), "doc_id bigint, text string")
    for place, name in enumerate(CLASHING):
        frame = frame.selectExpr("*", f"concat('{name}', doc_id) AS {name}" if place % 2 else f"{place} AS {name}")
    return frame


@pytest.fixture(scope="session")
def no_rows(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")


@pytest.fixture(scope="session")
def small():
    return SMALL
