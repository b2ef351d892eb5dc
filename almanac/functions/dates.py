"""Dates in free text. Results are arrays of dates, by pattern and then by place."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from almanac.functions import fixed

# Not next to a letter, digit or underscore, whatever the engine takes for a word's edge.
_L, _R = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"


def month_number(name: Column, months: dict[str, int]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in months.items() for x in pair])
    return F.try_element_at(table, F.lower(name))


def _date(y: Column, m: Column, d: Column) -> Column:
    return F.try_make_date(y.cast("int"), m.cast("int"), d.cast("int")) if hasattr(F, "try_make_date") else F.try_to_date(F.format_string("%04d-%02d-%02d", y.cast("int"), m.cast("int"), d.cast("int")), "yyyy-MM-dd")


def _matches(text: Column, pattern: str, fields: int) -> Column:
    """Array of arrays: the groups of each different match, in order."""
    whole = F.array_distinct(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)))
    return F.transform(whole, lambda x: F.array(*[F.regexp_extract(x, f"^{pattern.replace(_L, '').replace(_R, '')}$", k + 1) for k in range(fields)]))


def _keep(dates: list[Column]) -> Column:
    return F.array_distinct(F.array_compact(F.concat(*dates)))


def candidates_v1(text: Column, year: int = 2026) -> Column:
    """All dates of one fixed year; a day that does not exist is skipped."""
    d, m = r"(0?[1-9]|[12]\d|3[01])", r"(0?[1-9]|1[0-2])"
    y = F.lit(year)
    iso = _matches(text, rf"{_L}({year})[-./]{m}[-./]{d}{_R}", 3)
    dotted = _matches(text, rf"{_L}{d}\.{m}\.({year}){_R}", 3)
    short = F.transform(F.regexp_extract_all(text, F.lit(rf"{_L}({d}\.{m}\.)(?!\d)"), F.lit(1)), lambda x: F.split(x, r"\."))
    named = _matches(text, rf"(?iu){_L}{d}\s+([{fixed.MONTH_LETTERS}]+)\s+({year}){_R}", 3)
    return _keep(
        [
            F.transform(iso, lambda x: _date(y, x[1], x[2])),
            F.transform(dotted, lambda x: _date(y, x[1], x[0])),
            F.transform(short, lambda x: _date(y, x[1], x[0])),
            F.transform(named, lambda x: _date(y, month_number(x[1], fixed.MONTHS_V1), x[0])),
        ]
    )


def _by_kind_v15(text: Column, start: Column, end: Column) -> list[Column]:
    """Arrays of dates, one a pattern; a date without a year may fall into the next one."""
    crosses = F.year(end) > F.year(start)

    def near(y: Column, m: Column, d: Column) -> Column:
        this, following = _date(y, m, d), _date(y + 1, m, d)
        return F.when((this < start) & crosses, following).otherwise(this)

    iso = _matches(text, rf"{_L}(\d{{4}})[-./](\d{{1,2}})[-./](\d{{1,2}}){_R}", 3)
    dotted = _matches(text, rf"{_L}(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}}){_R}", 3)
    short = F.transform(F.array_distinct(F.regexp_extract_all(text, F.lit(rf"{_L}(\d{{1,2}}\.\d{{1,2}}\.)(?!\d)"), F.lit(1))), lambda x: F.split(x, r"\."))
    named = _matches(text, rf"(?iu){_L}(\d{{1,2}})\s+([{fixed.MONTH_LETTERS}]+)\s*(\d{{4}})?", 3)

    def month(x: Column) -> Column:
        m = month_number(x[1], fixed.MONTHS_V15)
        return F.when(x[2] == "", near(F.year(start), m, x[0])).otherwise(_date(F.nullif(x[2], F.lit("")), m, x[0]))

    return [
        F.transform(iso, lambda x: _date(x[0], x[1], x[2])),
        F.transform(dotted, lambda x: _date(x[2], x[1], x[0])),
        F.transform(short, lambda x: near(F.year(start), x[1], x[0])),
        F.transform(named, month),
    ]


def _if_digits(text: Column, found: Column, none: Column) -> Column:
    """No date is without a digit, and most texts are."""
    return F.when(~text.rlike("[0-9]"), none).otherwise(found)


def candidates_v15(text: Column, start: Column, days: int = fixed.WINDOW_DAYS) -> Column:
    """All dates within the window."""
    end = F.date_add(start, days)
    found = F.filter(_keep(_by_kind_v15(text, start, end)), lambda x: x.between(start, end))
    return _if_digits(text, found, F.array().cast("array<date>"))


def first_v15(text: Column, start: Column, days: int = fixed.WINDOW_DAYS) -> Column:
    """The first of these dates, or null; patterns after the one that has it are not tried."""
    end = F.date_add(start, days)
    firsts = [F.get(F.filter(k, lambda x: x.between(start, end)), F.lit(0)) for k in _by_kind_v15(text, start, end)]
    return _if_digits(text, F.coalesce(*firsts), F.lit(None).cast("date"))


_FIRST = r"(\d{4}-\d{2}-\d{2}|\d{1,2}\.\d{1,2}\.\d{4})"


def first_token(text: Column) -> Column:
    """The first ISO or dotted date as it stands, or null."""
    return F.nullif(F.regexp_extract(text, _FIRST, 1), F.lit(""))


def lenient(token: Column) -> Column:
    """Date of such a token: ISO ones must exist; dotted days beyond a month's end become its last."""
    d, m, y = (F.try_element_at(F.split(token, r"\."), F.lit(k)).try_cast("int") for k in (1, 2, 3))
    last = F.last_day(_date(y, m, F.lit(1)))
    dotted = F.when(d.between(1, 31), _date(y, m, F.least(d, F.dayofmonth(last))))
    return F.when(token.rlike(r"^\d{4}-"), F.try_to_date(token, "yyyy-MM-dd")).otherwise(dotted)


def parse_or_null(text: Column) -> Column:
    """A date that exists, or null."""
    return F.try_to_date(text, "yyyy-MM-dd")


def in_window(day: Column, start: Column, days: int = fixed.WINDOW_DAYS) -> Column:
    """Within the window, both ends included."""
    return day.between(start, F.date_add(start, days))


def run_date(run_id: Column) -> Column:
    return F.try_to_date(F.substring(run_id, 1, 10), "yyyy-MM-dd")
