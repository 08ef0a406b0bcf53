"""Wall-clock time at the fixed offset UTC+9, kept as TIMESTAMP_NTZ.

No expression here looks at the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KST_OFFSET_SECONDS = 9 * 3600

#: ISO 8601 as sources write it: date, any separator, time to the hour, minute or second with a
#: fraction after a point or comma, offset down to the second; each part with separators or without.
_DATE = r"\d{4}-\d{2}-\d{2}|\d{8}"
_FRACTION = r"(?:[.,]\d+)?"
_CLOCK = rf"\d{{2}}(?::\d{{2}}(?::\d{{2}}{_FRACTION})?)?|\d{{4}}(?:\d{{2}}{_FRACTION})?"
ISO = rf"(?s)^({_DATE})(?:.({_CLOCK})(Z|[+-](?:{_CLOCK}))?)?$"
#: What is no ISO 8601 but begins with a full second counts up to there.
SECOND_AND_MORE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"
_BLANK = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


#: A full second as sources write it, and an offset after it, digits as zeros.
_SHAPE = ("0000-00-00T00:00:00", "0000-00-00 00:00:00")
_OFFSET = ("+00:00", "-00:00")
#: What can follow the second in ISO 8601.
_AFTER = (".", ",", "Z", "+", "-")
_DIGITS = "0123456789"
_MARK = "\u0001"


def _shape(text: Column) -> Column:
    return F.translate(text, _DIGITS, "0" * len(_DIGITS))


def _usual(raw: Column) -> Column:
    """Times that begin with a full second, cut by place; null where that does not settle them.

    A fraction is passed over; then nothing, ``Z`` or an offset may follow. After a time written with
    ``T`` all that cannot continue it is ignored.
    """
    at = F.substring(raw, 1, 19)
    wall = at.try_cast("timestamp_ntz")
    follows, then = F.substring(raw, 20, 1), F.substring(raw, 21, 1)
    fraction = follows.isin(".", ",") & then.between("0", "9")
    zone = F.when(fraction, F.ltrim(F.substr(raw, F.lit(21)), F.lit(_DIGITS))).otherwise(
        F.substr(raw, F.lit(20))
    )
    hours, minutes = (F.substring(zone, place, 2).cast("int") for place in (2, 5))
    east = (hours * 3600 + minutes * 60) * F.when(zone.startswith("-"), -1).otherwise(1)
    return F.when(
        _shape(at).isin(*_SHAPE),
        F.when(zone == "", wall)
        .when(zone == "Z", F.timestamp_add("SECOND", F.lit(KST_OFFSET_SECONDS), wall))
        .when((F.substring(raw, 11, 1) == "T") & ~follows.isin(*_AFTER), wall)
        .when(
            _shape(zone).isin(*_OFFSET) & (hours < 24) & (minutes < 60),
            F.timestamp_add("SECOND", KST_OFFSET_SECONDS - east, wall),
        ),
    )


def _clock(text: Column) -> Column:
    """Hour, minute and second of a clock as ``hh:mm:ss``, whatever it leaves out."""
    whole = F.split_part(F.split_part(text, F.lit("."), F.lit(1)), F.lit(","), F.lit(1))
    digits = F.rpad(F.translate(whole, ":+-Z", ""), 6, "0")
    return F.regexp_replace(digits, r"^(..)(..)(..)$", "$1:$2:$3")


def _any_form(raw: Column) -> Column:
    # Each step uses the one before it once: Spark shares nothing inside a branch.
    text = F.regexp_replace(raw, _BLANK, "")
    # One pass of the pattern: what matches begins with a mark and has marks between its parts.
    marked = F.regexp_replace(text, ISO, f"{_MARK}$1{_MARK}$2{_MARK}$3")
    part = lambda n: F.split_part(marked, F.lit(_MARK), F.lit(n + 1))
    day = F.regexp_replace(part(1), r"^(\d{4})-?(\d\d)-?(\d\d)$", "$1-$2-$3 ")
    wall = F.concat(day, _clock(part(2))).try_cast("timestamp_ntz")
    offset = part(3)
    east = F.concat(F.substring(offset, 1, 1), _clock(offset)).try_cast("interval hour to second")
    ahead = F.make_dt_interval(hours=F.lit(9)) - east
    zoned = F.when(~offset.rlike("^.(2[4-9]|[3-9])"), wall + ahead)
    utc = wall + F.make_dt_interval(hours=F.lit(9))
    begun = F.substring(raw, 1, 19).try_cast("timestamp_ntz")
    return F.coalesce(
        F.when(
            marked.startswith(_MARK),
            F.when(offset == "", wall).when(offset == "Z", utc).otherwise(zoned),
        ),
        F.when(raw.rlike(SECOND_AND_MORE), begun),
    )


def kst_timestamp(raw: Column) -> Column:
    """Parse an ISO-8601 string to KST seconds; null when it cannot be read.

    Strings with ``Z`` or an offset are converted, strings without one are KST already. Of a
    string that is not ISO 8601 but begins with a full second, the rest is ignored. The pattern is
    tried only on what is in none of the usual forms, and as a lambda: inlined it would make the
    generated method of the whole projection too long for the JVM to compile.
    """
    rare = F.get(F.transform(F.array(raw), _any_form), F.lit(0))
    return F.coalesce(_usual(raw), rare)


def whole_second(at: Column) -> Column:
    """Cut a TIMESTAMP_NTZ to the second."""
    micros = (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("int") % 1_000_000
    return F.timestamp_add("MICROSECOND", -micros, at)


def kst_text(at: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a TIMESTAMP_NTZ, for display only."""
    return F.substring(at.cast("string"), 1, 19)
