"""Text helpers of the cleaning stage."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


#: Fixed value: white space as str.strip takes it.
_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

#: Fixed value: letters and spaces, then other ASCII. Anchored, which takes a fifth of the time of a search for a
#: character that must not occur.
_PLAIN = r"^[A-Za-z ]*+[\x00-\x1F!-@\[-`{-\x7F]*+\z"


def stripped(col: Column) -> Column:
    """The text without white space of any kind at its ends.

    Texts that begin and end with visible ASCII stay as they are, which a comparison of both ends tells in a third of the time.
    """

    def may_be_space(end: Column) -> Column:
        return (end < "!") | (end > "~")

    return F.when(may_be_space(col) | may_be_space(F.right(col, F.lit(1))), F.btrim(col, F.lit(_SPACE))).otherwise(col)


# fixed values in the next function: the two patterns define the output's column names
def standard_name(name: str) -> str:
    """Column name in snake case: trimmed, lower case, only ``[a-z0-9_]``."""
    name = re.sub(r"[\s\-]+", "_", name.strip().lower())
    return re.sub(r"[^a-z0-9_]", "", name)


def title_case(col: Column) -> Column:
    """Capitalise every run of letters (``3XL`` -> ``3Xl``, ``o'neil`` -> ``O'Neil``).

    ``initcap`` only looks at spaces. It serves ASCII text of letters and spaces that ends in anything
    but these (``Town-4``); any other text is cut into letter and non-letter runs.
    """
    runs = F.regexp_extract_all(F.lower(col), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    cut = F.array_join(
        F.transform(runs, lambda run: F.concat(F.upper(F.substring(run, 1, 1)), F.substr(run, F.lit(2)))),
        "",
    )
    return F.when(~col.rlike(_PLAIN), cut).otherwise(F.initcap(col))


def yes_no(col: Column) -> Column:
    """Spellings of a flag to ``Yes`` or ``No``; anything unknown is ``No``."""
    text = F.upper(stripped(col.cast("string")))
    return F.when(text.isin("TRUE", "YES"), F.lit("Yes")).otherwise(F.lit("No"))


def grouped_number(value: Column, decimals: int) -> Column:
    """Thousands-grouped text with a fixed number of decimals."""
    return F.format_number(value, decimals)


def rupees(cents: Column) -> Column:
    """Cents as grouped currency text."""
    return F.concat(F.lit("₹ "), grouped_number((cents / F.lit(100)).cast("decimal(38,2)"), 2))
