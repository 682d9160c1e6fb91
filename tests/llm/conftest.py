import pytest


@pytest.fixture(scope="session")
def texts(spark):
    """Documents that every operator has to take: nulls, empty and long texts, repeated rows, clashing columns."""
    base = "The small river runs past the old mill and the wide green field, where two brown horses stand all day in the sun and nobody minds them much. "
    rows = [
        (1, base * 2 + "One more line that is quite different from the rest of this page.", "x"), (2, None, None), (3, "", "x"), (4, " \n\t ", None), (None, "a text without id", "y"),
        (5, "short", "x"), (5, "short", "x"), (6, "long " * 30_000 + "end", "z"), (7, base * 2 + "One more line that is quite different from the rest of that page.", "x"), (8, "a" * 50_000, "w"), (9, "1" * 50_000, "w"),
    ]
    names = "doc_id bigint, text string, lang string, n_words string, r string, hits string, `a.b` string"
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], names)


@pytest.fixture(scope="session")
def none(texts):
    return texts.where("false")


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
