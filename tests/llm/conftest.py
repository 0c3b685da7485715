import pytest

#: Nulls, empty and blank texts, ties, repeated rows and a long text, in a table with extra columns of clashing names.
TEXTS = [
    "The quick brown fox jumps over the lazy dog and runs away",
    "The quick brown fox jumps over the lazy dog and runs away",
    None,
    "",
    " \t\n ",
    "one",
    "one two three four five six seven eight nine ten don't stop it's 42 <|endoftext|>",
    "Ünïcödé ñandú İstanbul ΣΑΣ 漢字 🙂   x\u001cy   z é",
    "word " * 30_000,
    "x" * 50_000,
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, "en", None if i % 4 == 3 else f"s{i % 3}", i) for i, t in enumerate(TEXTS)]
    rows += [(0, TEXTS[0], "en", "s0", 0), (None, "no id at all here", "en", "s1", 1), (None, None, None, None, None)]
    full = [(*r, "shard", 1.5, "fp", 7, "x") for r in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, shard string, size double, fingerprint string, component_id long, taken string"
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
