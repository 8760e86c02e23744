"""Text clean-up on string columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters counted as surrounding blank space.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Texts that mean "no value", compared after trimming, case matters.
NULL_TOKENS = (
    "", " ", "-", "--", "NA", "N/A", "NULL", "null", "None", "none", "NaN", "nan",
)


def _is_blank(character: Column) -> Column:
    return F.contains(F.lit(BLANKS), character)


def strip(text: Column) -> Column:
    """Remove blank space of any kind, not only U+0020, from both ends.

    Most cells have none, and looking at both edges is cheaper than trimming.
    """
    edges = _is_blank(F.left(text, F.lit(1))) | _is_blank(F.right(text, F.lit(1)))
    return F.when(edges, F.btrim(text, F.lit(BLANKS))).otherwise(text)


def blank_to_null(text: Column) -> Column:
    """Stripped text, NULL when nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def null_tokens(stripped: Column) -> Column:
    """NULL for the no-value texts. Expects stripped text."""
    return F.when(~stripped.isin(*NULL_TOKENS), stripped)


def column_name(raw: object) -> str:
    """Normalise one column header to a snake-case name."""
    name = str(raw).strip(BLANKS).lower().replace(" ", "_")
    name = re.sub(r"_{2,}", "_", re.sub(r"[%()/]", "", name))
    return name.strip(BLANKS).strip("_")
