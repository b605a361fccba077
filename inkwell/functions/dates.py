"""Free-form reference dates, without a UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def reference_date(raw: Column) -> Column:
    """A date: ISO day, ISO month, else year with whatever month and day can be told; null without a plausible year."""
    s = F.trim(raw)
    day = F.coalesce(F.try_to_timestamp(F.substring(s, 1, 10), F.lit("yyyy-MM-dd")), F.try_to_timestamp(F.substring(s, 1, 10), F.lit("yyyy/MM/dd")))
    month = F.try_to_timestamp(F.when(F.length(F.substring(s, 1, 7)) == 7, F.concat(F.substring(s, 1, 7), F.lit("-01"))), F.lit("yyyy-MM-dd"))
    year = F.nullif(F.regexp_extract(s, r"\b(1[5-9]\d{2}|20\d{2}|21\d{2})\b", 1), F.lit(""))
    # A range of months counts from its first; month names are told by three letters.
    name = F.lower(F.regexp_extract(s, r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\b", 1))
    number = reduce(lambda rest, k: F.when(name == MONTHS[k], F.lit(k + 1)).otherwise(rest), range(12), F.lit(1))
    in_month = F.nullif(F.regexp_extract(s, r"(?i)\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?\s+(\d{1,2})(?:st|nd|rd|th)?\b(?!\d)|\b(\d{1,2})(?:st|nd|rd|th)?\s+(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)", 1), F.lit(""))
    before = F.nullif(F.regexp_extract(s, r"(?i)(?<!\d)(\d{1,2})(?:st|nd|rd|th)?\s+(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)", 1), F.lit(""))
    told = F.coalesce(in_month, before).cast("int")
    text = lambda d: F.format_string("%s-%02d-%02d", year, number, d)
    free = F.when(year.isNotNull(), F.coalesce(F.try_to_timestamp(text(F.coalesce(told, F.lit(1))), F.lit("yyyy-MM-dd")), F.try_to_timestamp(text(F.lit(1)), F.lit("yyyy-MM-dd"))))
    return F.when(F.coalesce(s, F.lit("")) != "", F.coalesce(day, month, free)).cast("date")
