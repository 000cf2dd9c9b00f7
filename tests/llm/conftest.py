import pytest

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from here today.\nSecond line of it.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs far away from here today.\nSecond line of it.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs far away from here today.\nSecond line of it.", "en", "a"),
    (3, None, "en", None),
    (4, "", None, "b"),
    (5, " \t\n ", "de", "b"),
    (6, "Ein kurzer Satz über die Straße, released under the MIT License.", "de", "b"),
    (7, "wort " * 30_000, "de", "b"),
    (8, "x", "en", "c"),
    (None, "A text without an id, licensed under CC BY-NC 4.0.", "en", "c"),
    (None, "A text without an id, licensed under CC BY-NC 4.0.", "en", "c"),
    (10, "日本語 \U0001F600  \U0001F601 é\u0301 ½", "en", "c"),
]
CLASHING = ["score", "part", "order", "hits", "row", "rep", "n", "token", "window", "signature", "_label", "_unnamed", "row_key", "place", "path", "kept", "host"]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like the operators' own."""
    rows = [(i, t, g, s, len(t or ""), *["x"] * len(CLASHING)) for i, t, g, s in TEXTS]
    fields = ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {fields}").repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
