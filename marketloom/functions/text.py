"""Text rules of the cleaning jobs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Texts a CSV reader takes for a missing value.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def missing_to_null(text: Column) -> Column:
    return F.when(~text.isin(*MISSING_TEXTS), text)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))


def title_case(text: Column) -> Column:
    """Upper case after every non-letter, lower case elsewhere: ``o'neil`` gives ``O'Neil``.

    Texts of plain letters and blanks, the usual ones, need no search for runs of letters.
    """
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.when(text.rlike("^[A-Za-z ]*$"), F.initcap(text)).otherwise(F.array_join(F.transform(runs, F.initcap), ""))


def null_if_in(text: Column, *values: str) -> Column:
    return F.when(~text.isin(*values), text)
