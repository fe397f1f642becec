"""Column expressions used by more than one operator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the published data.
DOI_PREFIX = "https://doi.org/"
MODEL_SOURCE = "s2-fos-model"


def doi_key(doi: Column) -> Column:
    """DOI without its resolver prefix; case is kept."""
    return F.replace(doi, F.lit(DOI_PREFIX), F.lit(""))


def first_topic(path: str, topics: str = "topics") -> Column:
    """Field `path` of the first topic; NULL when there is no topic."""
    value = F.get(F.col(topics), F.lit(0))
    for part in path.split("."):
        value = value.getField(part)
    return value


def model_field(fields: str = "s2fieldsofstudy") -> Column:
    """Category of the first field-of-study entry that the classifier assigned."""
    assigned = F.filter(F.col(fields), lambda entry: entry["source"] == MODEL_SOURCE)
    return F.get(assigned, F.lit(0))["category"]


def list_length(leaf: str) -> Column:
    """Length of a list column, NULL for a NULL list.

    Pass one leaf (`topics.id`) rather than the list itself: the scan then reads that leaf only.
    """
    return F.array_size(F.col(leaf))


def year_bin(year: Column, width: int = 2) -> Column:
    """First year of the bin that holds `year`; rounds down for negative years too."""
    return (F.floor(year / F.lit(width)) * width).cast("int")


def percent(part: Column, whole: Column, digits: int) -> Column:
    """Rounded percentage, NULL when `whole` is zero."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole), digits)
