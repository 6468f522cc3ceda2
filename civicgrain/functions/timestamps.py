"""Normalising stated dates and times to one unambiguous form, in JVM expressions only.

An ordered cascade of anchored patterns is tried on each text; a pattern whose
match is no valid calendar date yields to the next one. Local times are resolved
by ``try_make_timestamp`` with a region zone. What becomes of hours that clocks skip or
repeat is a stated policy: by default a skipped hour moves on by the length of the gap, and
a repeated hour is the earlier one.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_ZONE = "America/New_York"

# Month names, English and Spanish.
MONTHS = (
    ("january", "jan", "enero"),
    ("february", "feb", "febrero"),
    ("march", "mar", "marzo"),
    ("april", "apr", "abril"),
    ("may", "mayo"),
    ("june", "jun", "junio"),
    ("july", "jul", "julio"),
    ("august", "aug", "agosto"),
    ("september", "sept", "sep", "septiembre", "setiembre"),
    ("october", "oct", "octubre"),
    ("november", "nov", "noviembre"),
    ("december", "dec", "diciembre"),
)
# Zone abbreviations. Those without a season follow the region's clock.
ZONES = {
    "Z": "+00:00", "UTC": "+00:00", "GMT": "+00:00",
    "ET": "America/New_York", "CT": "America/Chicago", "MT": "America/Denver", "PT": "America/Los_Angeles",
    "EST": "-05:00", "EDT": "-04:00", "CST": "-06:00", "CDT": "-05:00",
    "MST": "-07:00", "MDT": "-06:00", "PST": "-08:00", "PDT": "-07:00",
}

_NAMES = sorted((n for names in MONTHS for n in names), key=len, reverse=True)
_MON = "(?i:(?<![A-Za-z])(" + "|".join(_NAMES) + r")(?![A-Za-z])\.?)"
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
_END = r"(?!\d)"

# (pattern, replacement giving year-month-day; "-swap" where the two numbers may stand day first)
_FULL = (
    (r"(?<!\d)(\d{4})-(\d{2})-(\d{2})" + _END, "$1-$2-$3"),
    (r"(?<!\d)(\d{4})[/.](\d{1,2})[/.](\d{1,2})" + _END, "$1-$2-$3"),
    (r"(?<!\d)((?:19|20)\d{2})(\d{2})(\d{2})" + _END, "$1-$2-$3"),
    (_MON + r" ?" + _DAY + r",? (\d{4})" + _END, "$3-$1-$2"),
    (r"(?<!\d)" + _DAY + r"[ -](?:de )?" + _MON + r",?[ -](?:del? )?(\d{4})" + _END, "$3-$2-$1"),
    (r"(?<![\d/.-])(\d{1,2})([/.-])(\d{1,2})\2(\d{4}|\d{2})(?![\d/])", "$4-$1-$3-swap"),
)
_MONTH = (
    (_MON + r"(?: del?)? (\d{4})" + _END, "$2-$1"),
    (r"(?<![\d/.-])(\d{1,2})/(\d{4})(?![\d/])", "$2-$1"),
)
_NO_YEAR = (
    (_MON + r" " + _DAY + r"(?![\d:.]*\d)", "0-$1-$2"),
    (r"(?<!\d)" + _DAY + r" (?:de )?" + _MON, "0-$2-$1"),
    (r"(?<![\d/.-])(\d{1,2})/(\d{1,2})(?![\d/.-])", "0-$1-$2-swap"),
)
_URL_DAY = (
    (r"/((?:19|20)\d{2})-(\d{2})-(\d{2})(?=[/_.?-]|$)", "$1-$2-$3"),
    (r"/((?:19|20)\d{2})/(\d{2})/(\d{2})(?=[/_.?-]|$)", "$1-$2-$3"),
    (r"/(\d{2})-(\d{2})-((?:19|20)\d{2})(?=[/_.?-]|$)", "$3-$1-$2-swap"),
    (r"/((?:19|20)\d{2})(\d{2})(\d{2})(?=[/_.?-]|$)", "$1-$2-$3"),
)
_URL_EPOCH = r"[?&](?:start|ts|t|epoch|time|when|date)=(\d{13}|\d{10})(?!\d)"
_URL_SCHOOL_YEAR = r"/((?:19|20)\d{2})-(?:(?:19|20)\d{2}|\d{2})/"
_URL_YEAR = r"(?<!/uploads)/((?:19|20)\d{2})/"
_TIME = (
    r"(?<![\d:.])(\d{1,2})(?::(\d{2})(?::(\d{2})(?:[.,]\d+)?)?\s*(?:([AaPp])\.?\s?[Mm](?![A-Za-z])\.?)?"
    r"|\s*([AaPp])\.?\s?[Mm](?![A-Za-z])\.?)"
    r"\s*((?:" + "|".join(sorted(ZONES, key=len, reverse=True)) + r")(?![A-Za-z])|[+-]\d{2}:?\d{2}(?!\d))?"
)


def _month_map() -> Column:
    return F.create_map(*chain.from_iterable((F.lit(n), F.lit(i)) for i, names in enumerate(MONTHS, 1) for n in names))


def _int(text: Column) -> Column:
    return text.try_cast("int")


def _token(text: Column, pattern: str, order: str) -> Column:
    """The first match rewritten to year-month[-day]; empty when there is none."""
    return F.regexp_replace(F.regexp_extract(text, pattern, 0), pattern, order)


def let(value: Column, body) -> Column:
    """``body`` of a value computed once per row; plain reuse of a Column would copy its whole expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _valid(year: Column, month: Column, day: Column) -> Column:
    return F.try_make_timestamp_ntz(year, month, day, F.lit(0), F.lit(0), F.lit(0)).isNotNull()


def _parts(token: Column) -> Column:
    """struct(y, m, d) of a token year-month[-day][-swap]; a month above 12 changes place with the day if it may."""

    def read(part: Column) -> Column:
        word = F.lower(F.get(part, F.lit(1)))
        first, year, month, day = F.get(part, F.lit(0)), _int(F.get(part, F.lit(0))), F.coalesce(_int(word), F.try_element_at(_month_map(), word)), _int(F.get(part, F.lit(2)))
        raw = F.struct(F.when(F.length(first) == 2, year + 2000).otherwise(year).alias("y"), month.alias("m"), day.alias("d"))
        return let(raw, lambda r: F.when((r["m"] > 12) & (F.size(part) == 4), F.struct(r["y"].alias("y"), r["d"].alias("m"), r["m"].alias("d"))).otherwise(r))

    return let(F.split(token, "-"), read)


def _first(tokens: list[Column], ok) -> Column:
    """The first token of the cascade whose parts satisfy ``ok``."""
    stated = F.filter(F.array(*tokens), lambda t: t != "")
    return F.get(F.filter(F.transform(stated, _parts), ok), F.lit(0))


def tidy(text: Column) -> Column:
    """Blanks made plain; compact and dotted clock times put into colon form."""
    text = F.regexp_replace(text, r"[\s   ]+", " ")
    text = F.regexp_replace(text, r"(?<!\d)(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})?(?:[.,]\d+)?(?=Z|[+-]\d{2}:?\d{2}|[^\d]|$)", "$1-$2-$3 $4:$5:$6")
    text = F.regexp_replace(text, r"(\d{2}:\d{2}):(?!\d)", "$1")
    text = F.regexp_replace(text, r"(?<=\d{4}-\d{2}-\d{2})T(?=\d{2}:\d{2})", " ")
    return F.regexp_replace(text, r"(?<![\d.])(\d{1,2})\.(\d{2}) ?(?:hrs|hours|h)(?![A-Za-z])", "$1:$2")


def stated_date(text: Column, patterns=_FULL) -> Column:
    """struct(y, m, d) of the first pattern of the cascade that gives a valid day."""
    return _first([_token(text, p, order) for p, order in patterns], lambda x: _valid(x["y"], x["m"], x["d"]))


def stated_month(text: Column) -> Column:
    return _first([_token(text, p, order) for p, order in _MONTH], lambda x: x["m"].between(1, 12) & x["y"].between(1900, 2099))


def stated_day_without_year(text: Column) -> Column:
    """struct(y, m, d) with year 0 where only month and day stand in the text."""
    return _first([_token(text, p, order) for p, order in _NO_YEAR], lambda x: _valid(F.lit(2000), x["m"], x["d"]))


def with_year(date: Column, year: Column) -> Column:
    """The day in the given year; null if there is no year or the year lacks that day."""
    return F.when(_valid(year, date["m"], date["d"]), F.struct(year.alias("y"), date["m"].alias("m"), date["d"].alias("d")))


# What a local time may mean that a zone's clocks skip or show twice.
SKIPPED, REPEATED = ("later", "earlier", "null"), ("earlier", "later", "null")


def resolved_epoch(epoch: Column, stated: Column, zone: Column, skipped: str = "later", repeated: str = "earlier") -> Column:
    """Epoch seconds of a stated local time (epoch seconds as if it were UTC) under a policy.

    ``epoch`` is Java's resolution: later by the gap, the earlier of two. Clocks change by an hour or less in all
    zones in use, so the other reading of a time shown twice is looked for an hour, and half an hour, on.
    """
    if skipped not in SKIPPED or repeated not in REPEATED:
        raise ValueError(f"skipped is one of {SKIPPED}, repeated one of {REPEATED}")
    if (skipped, repeated) == ("later", "earlier"):
        return epoch
    wall = lambda e: _wall_seconds(e, zone)
    gap = wall(epoch) - stated  # more than 0 where the clocks skip the time
    second = F.coalesce(*(F.when(wall(epoch + d) == stated, epoch + d) for d in (3600, 1800)))
    moved = {"later": epoch, "earlier": epoch - gap, "null": F.lit(None).cast("bigint")}[skipped]
    twice = {"earlier": epoch, "later": second, "null": F.lit(None).cast("bigint")}[repeated]
    return F.when(gap != 0, moved).when(second.isNotNull(), twice).otherwise(epoch)


def _wall_seconds(epoch: Column, zone: Column) -> Column:
    """The zone's local time at a moment, in seconds as if it were UTC."""
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), epoch.cast("decimal(18,6)"))
    local = F.convert_timezone(F.lit("UTC"), zone, utc)
    return F.datediff(local.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400 + F.hour(local) * 3600 + F.minute(local) * 60 + F.floor(F.second(local))


def stated_moment(text: Column, date: Column, default_zone: Column, skipped: str = "later", repeated: str = "earlier") -> Column:
    """Epoch seconds of the clock time standing in the text on the given day, or null. ``skipped`` and ``repeated`` say what hours that clocks skip or repeat mean."""

    def read(hit: Column) -> Column:
        group = lambda g: F.regexp_extract(hit, _TIME, g)
        half = F.lower(F.concat(group(4), group(5)))
        name = group(6)
        table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in ZONES.items()))
        offset = F.regexp_replace(name, r"^([+-]\d{2}):?(\d{2})$", "$1:$2")
        zone = F.when(name == "", default_zone).otherwise(F.coalesce(F.try_element_at(table, name), offset))
        clock = F.struct(_int(group(1)).alias("h"), F.coalesce(_int(group(2)), F.lit(0)).alias("n"), F.coalesce(_int(group(3)), F.lit(0)).alias("s"), half.alias("half"), zone.alias("zone"))
        return let(clock, at)

    def at(c: Column) -> Column:
        twelve = c["h"].between(1, 12)
        hour = F.when(c["half"] == "", c["h"]).when(twelve & (c["half"] == "p"), c["h"] % 12 + 12).when(twelve, c["h"] % 12)
        ok = hour.between(0, 23) & c["n"].between(0, 59) & c["s"].between(0, 59) & date["d"].isNotNull()
        java = F.unix_timestamp(F.try_make_timestamp(date["y"], date["m"], date["d"], hour, c["n"], c["s"], c["zone"]))
        day = F.datediff(F.to_date(F.try_make_timestamp_ntz(date["y"], date["m"], date["d"], F.lit(0), F.lit(0), F.lit(0))), F.lit("1970-01-01").cast("date")).cast("bigint")
        return F.when(ok, resolved_epoch(java, day * 86400 + hour * 3600 + c["n"] * 60 + c["s"], c["zone"], skipped, repeated))

    return let(F.regexp_extract(text, _TIME, 0), read)


def iso_moment(epoch: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` of epoch seconds, whatever the session's time zone is."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(epoch / 86400).cast("int"))
    rest = F.pmod(epoch, F.lit(86400)).cast("int")
    return F.concat(day.cast("string"), F.format_string("T%02d:%02d:%02dZ", F.floor(rest / 3600).cast("int"), F.floor(rest / 60).cast("int") % 60, rest % 60))


def iso_day(date: Column) -> Column:
    return F.when(date["y"].isNull(), F.lit(None)).when(date["d"].isNull(), F.format_string("%04d-%02d", date["y"], date["m"])).otherwise(F.format_string("%04d-%02d-%02d", date["y"], date["m"], date["d"]))


def zone_of(source: Column | None, zones: Mapping[str, str] | None) -> Column:
    """The default zone of a row's source from a lookup, else New York."""
    if source is None or not zones:
        return F.lit(DEFAULT_ZONE)
    return F.coalesce(F.try_element_at(F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in zones.items())), source), F.lit(DEFAULT_ZONE))


def url_date(url: Column) -> Column:
    return stated_date(url, _URL_DAY)


def url_epoch(url: Column) -> Column:
    """Seconds of an epoch parameter of the address (10 digits, or 13 for milliseconds)."""
    digits = F.regexp_extract(url, _URL_EPOCH, 1)
    return F.when(digits != "", F.when(F.length(digits) == 13, F.floor(digits.try_cast("bigint") / 1000)).otherwise(digits.try_cast("bigint")))


def url_year(url: Column, month: Column) -> Column:
    """The year an address states for a month: a dated folder, a moment, a school year (July to June) or a year folder."""
    start = _int(F.regexp_extract(url, _URL_SCHOOL_YEAR, 1))
    of_moment = let(url_epoch(url), lambda e: F.year(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(e / 86400).cast("int"))))
    return F.coalesce(url_date(url)["y"], of_moment, F.when(month >= 7, start).otherwise(start + 1), _int(F.regexp_extract(url, _URL_YEAR, 1)))
