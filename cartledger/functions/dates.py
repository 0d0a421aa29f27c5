"""Dates from text, free of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# English month names, weekdays, and the first year of two-digit years.
MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september",
    "october", "november", "december",
)
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
FIRST_SHORT_YEAR = 1969

_MONTH = f"({'|'.join(f'{m}|{m[:3]}' for m in MONTHS)}|sept)"
_WEEKDAY = rf"(?:(?:{'|'.join(f'{d}|{d[:3]}' for d in WEEKDAYS)})\.?,? +)?"
#: Time of day, its half of the day, and its offset from UTC.
_TIME = (
    r"(?:(?:[ T]+|, *)(\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)(?: *([ap])\.?m\.?)?"
    r" *(z|utc|gmt|[+-]\d{2}:?\d{2})?)?\s*$"
)
_PLAIN_ISO = r"^\s*\d{4}-\d{1,2}(-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,9})?)?)?)?\s*$"
#: What most text is, told without trying one part after the other.
_EXACT_ISO = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$"
_SLASHED = r"(\d{1,2})[/.-](\d{1,2})[/.-](\d{4}|\d{2})"
_JOINED = r"(\d{4})(\d{2})(\d{2})"

#: The forms of a date: its pattern, and what its groups are put as: year, month, day, time, half, offset.
FORMS = {
    "iso": (r"(\d{4})-(\d{1,2})-(\d{1,2})" + _TIME, "$1 $2 $3 $4 $5 $6"),
    "year_first": (r"(\d{4})[/.](\d{1,2})[/.](\d{1,2})" + _TIME, "$1 $2 $3 $4 $5 $6"),
    "month_first": (_SLASHED + _TIME, "$3 $1 $2 $4 $5 $6"),
    "day_first": (_SLASHED + _TIME, "$3 $2 $1 $4 $5 $6"),
    "compact": (_JOINED + _TIME, "$1 $2 $3 $4 $5 $6"),
    "compact_time": (_JOINED + r"T?(\d{2})(\d{2})(\d{2})(z)?\s*$", "$1 $2 $3 $4:$5:$6  $7"),
    "compact_minutes": (_JOINED + r"T?(\d{2})(\d{2})(z)?\s*$", "$1 $2 $3 $4:$5  $6"),
    "month_day": (rf"{_WEEKDAY}{_MONTH}\.? +(\d{{1,2}}),? +(\d{{4}}){_TIME}", "$3 $1 $2 $4 $5 $6"),
    "day_month": (rf"{_WEEKDAY}(\d{{1,2}})[ -]+{_MONTH}\.?,?[ -]+(\d{{4}}){_TIME}", "$3 $2 $1 $4 $5 $6"),
}
#: What becomes of a time with an offset: its time in UTC, or null.
OFFSETS = ("utc", "reject")
_MARK = "\u0001"


def _stamp(parts: Column, named: bool, offsets: str) -> Column:
    """The timestamp of the parts of a date; nulls and misfits give null."""
    year, month, day, time, half, offset = (F.get(parts, F.lit(i)) for i in range(6))
    century = F.when(year.try_cast("int") < FIRST_SHORT_YEAR % 100, "20").otherwise("19")
    if named:
        names = F.array(*[F.lit(m[:3]) for m in MONTHS])
        month = F.array_position(names, F.lower(F.substring(month, 1, 3))).cast("string")
    hour = F.substring_index(time, ":", 1).try_cast("int")
    noon = F.when(F.lower(half) == "p", 12).otherwise(0)
    clock = F.when(half == "", time).otherwise(
        F.concat(F.when(hour.between(1, 12), hour % 12 + noon).cast("string"), F.regexp_replace(time, r"^\d+", ""))
    )
    date = F.concat(F.when(F.length(year) == 2, century).otherwise(""), F.concat_ws("-", year, month, day))
    stamp = F.concat(date, F.when(time == "", "").otherwise(F.concat(F.lit(" "), clock))).try_cast("timestamp_ntz")
    if offsets == "reject":
        return F.when(offset == "", stamp)
    away = F.substring(offset, 2, 2).try_cast("int") * 60 + F.substring(offset, -2, 2).try_cast("int")
    minutes = F.when(offset.startswith("+"), -away).when(offset.startswith("-"), away).otherwise(0)
    return F.when(offset == "", stamp).otherwise(stamp + F.make_dt_interval(F.lit(0), F.lit(0), minutes))


def parse_as(text: Column, form: str, offsets: str = "utc") -> Column:
    """A timestamp without zone from text of one form of ``FORMS``, null where it does not fit."""
    if offsets not in OFFSETS:
        raise ValueError(f"offsets must be one of {OFFSETS}, not {offsets!r}")
    pattern, order = FORMS[form]
    # Taken apart once: what a function over an array is given is evaluated before its steps.
    marked = F.regexp_replace(text, F.lit(rf"(?i)^\s*{pattern}"), F.lit(order.replace(" ", _MARK)))
    named = form in ("month_day", "day_month")
    found = F.get(F.transform(F.array(F.split(marked, _MARK)), lambda p: _stamp(p, named, offsets)), F.lit(0))
    if form == "iso":  # most text is, and needs no taking apart
        return F.coalesce(F.when(text.rlike(_PLAIN_ISO), text).try_cast("timestamp_ntz"), found)
    return found


def parse_timestamp(text: Column, day_first: bool = False, offsets: str = "utc") -> Column:
    """A timestamp without zone from text, null where the text is no date.

    Every value is read by itself, by the first form that it fits: ISO; ``2023/01/06``;
    ``05/01/2023`` or ``5/1/23``, month first unless ``day_first``, or the other way round where only
    that is a date; ``20230105`` and ``20230105103000``; ``Jan 5, 2023``; ``5 Jan 2023``, ``05-Jan-2023``
    and ``Thu, 05 Jan 2023``. Each may end with a time of day, also with AM or PM, and an offset, which is
    taken off to give the time in UTC, or with ``offsets="reject"`` makes the value null.
    """
    order = list(FORMS)
    if day_first:
        a, b = order.index("month_first"), order.index("day_first")
        order[a], order[b] = order[b], order[a]
    # Nulls, and text that is plainly ISO, need none of the forms.
    tried = F.coalesce(*[parse_as(text, form, offsets) for form in order])
    exact = F.when(text.rlike(_EXACT_ISO), text.try_cast("timestamp_ntz"))
    return F.coalesce(exact, F.when(text.isNotNull(), tried))


def form_counts(text: Column, name: str, offsets: str = "utc") -> list[Column]:
    """Aggregates, their names beginning with ``name``: how many values fit each form, and how
    many there are."""
    fits = [F.count(parse_as(text, form, offsets)).alias(f"{name}_{form}") for form in FORMS]
    return [*fits, F.count(text).alias(f"{name}_values")]


def best_form(name: str) -> Column:
    """(fits, form) of the form that most values fit, by what ``form_counts`` found under ``name``;
    the earlier one of equals."""
    ranked = [
        F.struct(F.col(f"{name}_{form}").alias("fits"), F.lit(-i).alias("place"), F.lit(form).alias("form"))
        for i, form in enumerate(FORMS)
    ]
    return F.array_max(F.array(*ranked))
