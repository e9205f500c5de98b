"""Text and JSON cells: symbols, grades, firm names, firm -> score maps."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarterdeck.functions.names import GRADE_SCORES


def plain_name(name: str) -> str:
    """A column name without anything but letters and digits."""
    return re.sub(r"[\W_]+", "", name)


def plain_text(text: Column) -> Column:
    return F.regexp_replace(text, r"[\W_]+", "")


def without_blanks(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def entity_from_path(path: Column, pattern: str = r"_([^_/]+)\.csv$") -> Column:
    return F.regexp_extract(path, pattern, 1)


def iso_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def missing_to_null(number: Column) -> Column:
    """One kind of missing value: NaN becomes null."""
    return F.nanvl(number, F.lit(None).cast("double"))


def grade_score(grade: Column, scores: Mapping[str, int] = GRADE_SCORES) -> Column:
    """Score of a grade, 0 when unknown; spelling differs by source in blanks, hyphens, case."""
    pairs = [F.lit(part) for name, score in scores.items()
             for part in (plain_name(name).lower(), score)]
    plain = F.translate(F.lower(grade), " -_./", "")
    found = F.try_element_at(F.create_map(*pairs), plain)
    return F.coalesce(found, F.lit(0))


def scores_to_json(entries: Column) -> Column:
    """Array of (firm, score) structs -> JSON object with sorted keys."""
    return F.to_json(F.map_from_entries(F.array_sort(entries)))


def mean_of_json(cell: Column) -> Column:
    """Mean of the values of a JSON object; a missing cell counts as 0."""
    values = F.map_values(F.from_json(cell, "map<string,string>"))
    numbers = F.transform(values, lambda v: v.try_cast("double"))
    total = F.aggregate(numbers, F.lit(0.0), lambda acc, v: acc + v)
    mean = F.try_divide(total, F.size(numbers).cast("double"))
    return F.when(cell.isNull() | (cell == "nan"), F.lit(0.0)).otherwise(mean)
