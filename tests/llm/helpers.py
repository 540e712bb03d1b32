"""Awkward tables that every operator has to take."""

from __future__ import annotations

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def awkward_documents(spark, *more):
    """Nulls in every column, empty and blank texts, a long one, ties and repeated rows."""
    long_text = " ".join(f"word{i % 977} and thing{i % 13}" for i in range(20_000))
    rows = [
        (1, "plain words stand here in a line of their own today", "en", "a", 51),
        (1, "plain words stand here in a line of their own today", "en", "a", 51),
        (2, None, "en", "a", None),
        (3, "", None, None, 0),
        (None, "plain words stand here in a line of their own today", None, None, None),
        (4, " \n\t\n ", "de", "a", 5),
        (5, long_text, "en", "b", len(long_text)),
        (6, "naïve café übergrößen \U0001f642 漢字 " * 9, "xx", "b", None),
        (7, "x", "en", "b", 1),
        *more,
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def with_clashes(df):
    """Extra columns named as the operators name their own."""
    names = "row k1 k2 tid did raw spans kept lines places n_tokens ids leaks segments root class_id strong weak html"
    for name in names.split():
        df = df.selectExpr("*", f"'x' AS {name}")
    return df.selectExpr("*", "1 AS `odd, name: a.b`")
