"""Cleansing of raw text reports. Lineage columns pass through untouched."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.text import column_name, null_tokens, strip

LINEAGE = ("source_file", "source_path", "source_key")
# Names that rows carry on their way into the layers.
INTERNAL = ("__wide", "__unreadable")


def data_columns(df: DataFrame) -> list[str]:
    """Columns that came from the report itself."""
    return [c for c in df.columns if c not in LINEAGE]


def text_columns(df: DataFrame) -> list[str]:
    """Report columns still held as text."""
    return [c for c in data_columns(df) if isinstance(df.schema[c].dataType, StringType)]


def standardize_columns(df: DataFrame) -> DataFrame:
    """Snake-case column names; names that fall together are an error."""
    names = [c if c in LINEAGE else column_name(c) for c in df.columns]
    clashes = sorted(name for name, times in Counter(names).items() if times > 1)
    if clashes:
        raise ValueError(f"column names fall together: {', '.join(clashes)}")
    return df.toDF(*names)


def _plain_name(raw: str) -> str:
    return column_name(raw).replace("`", "").replace(".", "_")


def unite_columns(df: DataFrame) -> DataFrame:
    """Snake-case names of many files' rows.

    Files may spell a name differently; each has only one of the spellings, so columns
    whose names fall together are one column. Signs that mean something in a column
    reference do not stay in names.
    """
    groups: dict[str, list[int]] = {}
    for i, c in enumerate(df.columns):
        groups.setdefault(c if c in LINEAGE else _plain_name(c), []).append(i)
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return flat.select(
        *[F.coalesce(*[F.col(f"c{i}") for i in places]).alias(n) for n, places in groups.items()]
    )


def distinct_names(names: list[str]) -> list[str]:
    """One file's header with repeated names told apart by a number, as .1, .2 and so on.

    Names of lineage columns count as taken, however a file spells them.
    """
    taken = {*LINEAGE, *map(_plain_name, INTERNAL)}
    result = []
    for name in names:
        new, times = name, 0
        while _plain_name(new) in taken or not _plain_name(new):
            times += 1
            new = f"{name}.{times}" if name.strip() else f"Unnamed {len(result)}.{times}"
        taken.add(_plain_name(new))
        result.append(new)
    return result


def _each_text(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    return df.withColumns({c: change(F.col(c)) for c in text_columns(df)})


def trim_text(df: DataFrame) -> DataFrame:
    """Strip every text cell; typed columns stay as they are."""
    return _each_text(df, strip)


def handle_nulls(df: DataFrame) -> DataFrame:
    """Strip every text cell and turn no-value texts into NULL.

    Two projections, so that each cell is stripped once though it is used twice.
    """
    return _each_text(trim_text(df), null_tokens)


def remove_duplicates(df: DataFrame) -> DataFrame:
    """One copy of each row per source file; equal nulls count as equal.

    All columns form the key, so copies collapse before the shuffle however
    many there are.
    """
    return df.dropDuplicates()


def union_files(frames: Iterable[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name, absent ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
