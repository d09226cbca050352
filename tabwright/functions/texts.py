"""Text expressions: JSON objects held in strings, and dates written as text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabwright.functions.columns import strip


# Spelling of a number in text.
NUMBER_TEXT = (r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?"
               r"|[iI]nf(inity)?|[nN]a[nN])\s*$")


def text_to_double(column: Column) -> Column:
    """Number written in a text value, else NULL."""
    return F.when(column.rlike(NUMBER_TEXT), column.try_cast("double"))


def text_to_long(column: Column) -> Column:
    return F.when(column.rlike(r"^\s*[+-]?\d+\s*$"), column.try_cast("bigint"))


def text_to_boolean(column: Column) -> Column:
    return F.when(column.isin("True", "TRUE", "true"), F.lit(True)) \
            .when(column.isin("False", "FALSE", "false"), F.lit(False))


def looks_like_json(column: Column) -> Column:
    return strip(column).startswith("{")


def json_scalar(column: Column) -> Column:
    """Scalar of a JSON object text: its ``name``, else its first value, else the trimmed text.

    Text that is not wrapped in braces is returned unchanged.
    """
    trimmed = strip(column)
    quoted = F.replace(column, F.lit("'"), F.lit('"'))
    repaired = F.regexp_replace(quoted, r",\}\z", "}")
    entries = F.map_entries(F.from_json(repaired, "map<string,string>"))

    def pick(e: Column) -> Column:
        """Scalar of the parsed entries; the last entry of a repeated key wins."""
        key = F.when(F.exists(e, lambda x: x["key"] == "name"), F.lit("name")) \
            .otherwise(F.get(e, F.lit(0))["key"])
        last = F.element_at(F.filter(e, lambda x: x["key"] == key), -1)["value"]
        return F.when(e.isNull() | (F.size(e) == 0), trimmed).otherwise(last)

    # The one-element array binds the parsed entries, so that a text is parsed once.
    scalar = F.get(F.transform(F.array(entries), pick), F.lit(0))
    wrapped = trimmed.startswith("{") & trimmed.endswith("}")
    return F.when(wrapped, scalar).otherwise(column)


def date_shape(date_format: str) -> str:
    """Pattern of the required first part of a date format, to refuse other text cheaply."""
    parts = {"y": r"\d", "M": r"\d", "d": r"\d", "H": r"\d", "m": r"\d", "s": r"\d"}
    shape = ""
    for run in re.finditer(r"'[^']*'|([A-Za-z])\1*|[^A-Za-z\[']", date_format.split("[")[0]):
        text = run.group()
        if text.startswith("'"):
            shape += re.escape(text.strip("'"))
        elif text[0] in parts:
            letter = r"[A-Za-z]" if text.startswith("MMM") else parts[text[0]]
            shape += letter + (f"{{{len(text)}}}" if len(text) > 1 else "{1,2}")
        elif text.isalpha():
            shape += ".*"
        else:
            shape += re.escape(text)
    return "^" + shape


def parse_datetime(column: Column, formats: Sequence[str]) -> Column:
    """Timestamp of a text value under the first matching format, else NULL.

    Text whose length or shape no format can have is refused before any parsing.
    """
    trimmed = strip(column)
    tried = F.coalesce(*[F.when(trimmed.rlike(date_shape(f)), F.try_to_timestamp(trimmed, F.lit(f)))
                         for f in formats])
    return F.when(F.length(trimmed).between(8, 40), tried)
