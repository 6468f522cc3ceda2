"""Dates in link texts and document texts, as ordered patterns that fall through when invalid."""

from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicgrain.functions.text import normalize_dashes, url_year
from civicgrain.functions.timestamps import let

# English month names.
_NAMES = "january february march april may june july august september october november december".split()
_FULL, _ABBR = "|".join(_NAMES), "|".join(n[:3] for n in _NAMES) + "|sept"


def _valid(year: Column, month: Column, day: Column) -> Column:
    return F.to_date(F.try_make_timestamp_ntz(year, month, day, F.lit(0), F.lit(0), F.lit(0)))


def _month(name: Column) -> Column:
    table = F.create_map(*chain.from_iterable((F.lit(n[:3]), F.lit(i)) for i, n in enumerate(_NAMES, 1)))
    return F.try_element_at(table, F.lower(F.substring(name, 1, 3)))


_CUT = "\u0001"
# Pieces that forms of dates are put together from.
_DAY, _TWO, _YEAR, _GAP, _ORDINAL, _JOINED = "([0-9]{1,2})", "([0-9]{2})", "([0-9]{4})", r"\s+", "(?:st|nd|rd|th)?", "[-/]"


def _name(names: str) -> str:
    return f"({names})[.]?{_GAP}"


class _Reading:
    """The first match of a form in a text, taken apart once and read group by group."""

    def __init__(self, text: Column, form: str) -> None:
        self.form, groups = "(?i)" + form, re.compile(form).groups
        # the match is found in the text and then rewritten: two passes, however many groups
        found = F.regexp_replace(F.regexp_extract(text, self.form, 0), self.form, _CUT.join(f"${g}" for g in range(1, groups + 1)))
        self.parts = F.split(found, _CUT)

    def date(self, year: int | Column, month: int, day: int | None = None, century: bool = False) -> Column:
        """The date of the groups, the first of the month without a day; null if the calendar lacks it or nothing matched.

        With ``century`` a year of two digits is of this century below 50.
        """

        def read(parts: Column) -> Column:
            part = lambda g: F.get(parts, F.lit(g - 1))
            number = lambda g: part(g).try_cast("int")
            y = F.when(F.size(parts) > 1, year) if isinstance(year, Column) else number(year)
            if century:
                y = F.when(F.length(part(year)) == 2, y + F.when(y < 50, 2000).otherwise(1900)).otherwise(y)
            return _valid(y, F.coalesce(number(month), _month(part(month))), F.lit(1) if day is None else number(day))

        return let(self.parts, read)


def meeting_date(text: Column, url: Column, fallback_year: Column | int | None = None, compat: bool = False) -> Column:
    """The date in a link text by eight ordered patterns; null if none is valid.

    ``compat`` keeps an old reading in which an ISO date whose year ends in a month's number
    is taken for month, day, year.
    """
    t, u = normalize_dashes(F.coalesce(text, F.lit(""))), F.coalesce(url, F.lit(""))
    year = F.coalesce(url_year(u), F.lit(fallback_year).cast("int") if not isinstance(fallback_year, Column) else fallback_year)
    read = lambda form: _Reading(t, form)
    numeric = read(_JOINED.join((_DAY, _DAY, "([0-9]{2,4})")) if compat else "(?<![0-9])" + _JOINED.join((_DAY, _DAY, "([0-9]{4}|[0-9]{2})")) + "(?![0-9])")
    return F.coalesce(
        *(read(_name(n) + _DAY + _ORDINAL + ",?" + _GAP + _YEAR).date(3, 1, 2) for n in (_FULL, _ABBR)),
        *(read(_name(n) + _YEAR).date(2, 1) for n in (_FULL, _ABBR)),
        read(_name(_FULL) + _DAY + r"\b").date(year, 1, 2),
        numeric.date(3, 1, 2, century=True),
        read(_JOINED.join((_YEAR, _DAY, _DAY))).date(1, 2, 3),
        read(_name(_ABBR) + _DAY + r"\b").date(url_year(u), 1, 2),
    )


def text_date(text: Column) -> Column:
    """The date in the first 3,000 characters of a document: only the first match of each of four forms is tried."""
    read = lambda *parts: _Reading(F.substring(text, 1, 3000), r"\b" + "".join(parts) + r"\b")
    return F.coalesce(
        read("(", _FULL, "|", _ABBR, ")", _GAP, _DAY, ",?", _GAP, _YEAR).date(3, 1, 2), read(_DAY, _GAP, "(", _FULL, ")", _GAP, _YEAR).date(3, 2, 1),
        read("/".join((_DAY, _DAY, _YEAR))).date(3, 1, 2), read("-".join((_YEAR, _TWO, _TWO))).date(1, 2, 3),
    )


def in_window(date: Column, as_of: str | Column) -> Column:
    """Whether a date is at most a year before ``as_of``; null for no date."""
    return date >= F.add_months(F.to_date(as_of) if isinstance(as_of, Column) else F.lit(as_of).cast("date"), -12)
