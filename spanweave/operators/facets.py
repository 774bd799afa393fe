"""Filters of a report's facets."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def facet(columns: str | Collection[str], selected: Collection, options: Collection, cleared: bool = False) -> Column:
    """Everything selected, or nothing but not cleared: no filter, nulls kept. Cleared: no rows. Else: any of the columns has a selected value."""
    names = [columns] if isinstance(columns, str) else list(columns)
    if not selected:
        return F.lit(not cleared)
    if set(selected) >= set(options):
        return F.lit(True)
    hit = F.lit(False)
    for c in names:
        hit |= F.coalesce(F.col(c).isin(*selected), F.lit(False))
    return hit


def yes_no(column: str, choice: str) -> Column:
    """'yes', 'no', or anything else for both."""
    return F.col(column) == F.lit(choice == "yes") if choice in ("yes", "no") else F.lit(True)


def search(column: str, text: str) -> Column:
    """Contains a text, in whatever case."""
    return F.lower(column).contains(text.strip().lower())


def search_options(options: DataFrame, column: str, text: str, most: int = 120) -> DataFrame:
    """The first options in order that contain a text, as many as are shown at once."""
    return options.where(search(column, text)).orderBy(column).limit(most)
