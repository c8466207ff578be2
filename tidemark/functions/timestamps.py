"""Timestamp text: which forms are accepted, and the column job that reads them."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted text forms.  Date, blank or "T", time to the second,
# and a fraction of up to six digits.
DATE_FORM = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
TIME_FORM = r"([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\.[0-9]{1,6})?"
ZONE_FORM = r"(Z|[+-][0-9]{2}:[0-9]{2})"
TIMESTAMP_FORM = f"{DATE_FORM}([ T]{TIME_FORM})?"
ZONED_TIMESTAMP_FORM = f"{DATE_FORM}([ T]{TIME_FORM}{ZONE_FORM}?)?"


def _is_calendar_day(text: str) -> bool:
    try:
        date.fromisoformat(text[:10])
    except ValueError:
        return False
    return True


def is_date_text(text: str) -> bool:
    return re.fullmatch(DATE_FORM, text) is not None and _is_calendar_day(text)


def is_timestamp_text(text: str, zoned: bool = False) -> bool:
    form = ZONED_TIMESTAMP_FORM if zoned else TIMESTAMP_FORM
    return re.fullmatch(form, text) is not None and _is_calendar_day(text)


def has_zone(text: str) -> bool:
    return re.search(f"{TIME_FORM}{ZONE_FORM}$", text) is not None


def is_zone(text: str) -> bool:
    return re.fullmatch(ZONE_FORM, text) is not None


def normalise_timestamp(c: Column) -> Column:
    """Mixed timestamp text to microsecond ``timestamp_ntz``; NULL when malformed.

    The form is checked first because the cast alone is lenient (it reads a bare
    number as a year, for one); the cast then rejects days that do not exist.
    """
    return F.when(c.rlike(rf"\A{TIMESTAMP_FORM}\z"), c.try_cast("timestamp_ntz"))
