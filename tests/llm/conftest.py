import pytest

TEXTS = [
    "The quick brown fox jumps over the lazy dog and runs away from the old grey wolf at night.",
    "Der schnelle braune Fuchs springt über den faulen Hund und läuft vor dem alten Wolf davon.",
    "Le renard brun saute par-dessus le chien paresseux et s'enfuit devant le vieux loup gris.",
    "El zorro marrón salta sobre el perro perezoso y huye del viejo lobo gris por la noche.",
]
LANGS = ["en", "de", "fr", "es"]


@pytest.fixture
def odd_docs(spark):
    """Nulls in any column, empty and long texts, repeated rows, and columns of clashing names."""
    long = " ".join(f"word{i % 977} of many" for i in range(20_000))
    rows = [(i, TEXTS[i % 4] + f" Number {i}.", LANGS[i % 4], f"s{i % 3}", i) for i in range(40)]
    rows += [
        (100, None, "en", "s0", 1), (101, "", "en", "s0", 1), (102, " \n\t ", None, None, 1), (103, "123 !?", "de", "s1", 1),
        (None, TEXTS[0], "en", None, 1), (104, TEXTS[0], None, "s1", None), (105, long, "en", "s2", 1),
        (0, TEXTS[0] + " Number 0.", "en", "s0", 0), (0, TEXTS[0] + " Number 0.", "en", "s0", 0),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    df = spark.createDataFrame(rows, schema)
    for name in ("score", "lang_pred", "mix", "tk", "stays", "component", "row", "n", "c", "prefix", "h", "copies", "size"):
        df = df.selectExpr("*", f"'mine' AS {name}")
    return df


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
