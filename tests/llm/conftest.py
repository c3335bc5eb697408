import pytest
from samples import prose

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and very long texts, ties, repeated rows, other scripts, control strings."""
    long = "\n".join(f"{prose(k, 12).capitalize()}." for k in range(900))
    base = prose(1, 120)
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, base), (5, base), (6, base + " more words here"), (7, base.upper()), (8, long), (9, "x" * 5000), (9, "x" * 5000),
        (10, "é漢😀 " * 200), (11, "one"), (12, "one two"), (None, "no id at all " * 30), (None, None), (13, "a\x00b <|endoftext|> ▁ </s>[INST]"), (14, long[:3000] + prose(2, 40) + long[3000:5000]),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in odd_texts]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def clashing(odd_docs):
    """The same rows with extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    names = "slot shard score kept component_id h doc spans row label quality vec_id word n size".split()
    return odd_docs.select("*", *(F.lit("clash").alias(n) for n in names))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
