"""Columns of library records: a structure, annotation tokens, then eleven trailing fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from simsift.functions.fingerprints import SPACE, tokens

#: The record's fields in order, and texts that a reader takes for missing numbers.
FIELDS = ("smiles", "id", "MW", "HAC", "sLogP", "HBA", "HBD", "RotBonds", "FSP3", "TPSA", "Type", "InChIKey")
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def record_tokens(line: Column) -> Column:
    return tokens(line, SPACE)


def structure(parts: Column) -> Column:
    return F.get(parts, F.lit(0))


def column_at(parts: Column, n: int) -> Column:
    """Token n, null if the record is shorter."""
    return F.get(parts, F.lit(n))


def identifier(parts: Column) -> Column:
    """The eleventh token from the right: annotation tokens may precede it."""
    return F.get(parts, F.size(parts) - 11)


def annotation(parts: Column) -> Column:
    return F.slice(parts, 2, F.greatest(F.lit(0), F.size(parts) - 12))


def complete(parts: Column) -> Column:
    return F.size(parts) >= len(FIELDS)


def checked(parts: Column, line: Column) -> Column:
    """The tokens; raises on a record with fewer than its twelve fields."""
    short = F.raise_error(F.concat(F.lit("record has fewer than 12 fields: "), line))
    return F.when(complete(parts), parts).otherwise(short.cast("array<string>"))


def base_name(path: Column, suffix: str = ".cxsmiles.bz2") -> Column:
    """A path's last part without the suffix; null if it doesn't end so."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.when(F.endswith(name, F.lit(suffix)), F.substring(name, F.lit(1), F.length(name) - len(suffix)))


def number(text: Column) -> Column:
    """A double, null where the text is missing or no number."""
    return F.when(~text.isin(*MISSING), text.try_cast("double"))
