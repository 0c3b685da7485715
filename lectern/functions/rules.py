"""Metadata inference from titles, as column functions over a configurable rule set."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.paths import PDF
from lectern.schema import LMS


@dataclass(frozen=True)
class Keyword:
    """Texts with ``word`` (anywhere, if not ``whole``; only in a teaching week, if ``in_week``) are of this type."""

    word: str
    type: str
    subtype: str
    whole: bool = True
    in_week: bool = False


#: Month abbreviations, English and French.
MONTHS = {
    "jan": 1, "feb": 2, "fev": 2, "fév": 2, "mar": 3, "apr": 4, "avr": 4, "may": 5, "mai": 5, "jun": 6,
    "jui": 6, "jul": 7, "aug": 8, "aou": 8, "aoû": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12, "déc": 12,
}

#: Teaching days of the autumn semester 2025 and their weeks; the break has none.
AUTUMN_2025 = {
    "2025-09-10": 1, "2025-09-17": 2, "2025-09-24": 3, "2025-10-01": 4, "2025-10-08": 5, "2025-10-15": 6, "2025-10-22": None,
    "2025-10-29": 7, "2025-11-05": 8, "2025-11-12": 9, "2025-11-19": 10, "2025-11-26": 11, "2025-12-03": 12, "2025-12-10": 13,
    "2025-12-17": 14,
}

#: Keywords in the order in which they are tried.
KEYWORDS = (
    Keyword("exam", "exam", "previous_year_exam"),
    Keyword("exams", "exam", "previous_year_exam"),
    Keyword("solution", "practice", "homework", in_week=True),
    Keyword("solutions", "practice", "homework", in_week=True),
    Keyword("homework", "practice", "homework"),
    Keyword("problem", "practice", "homework", in_week=True),
    Keyword("problems", "practice", "homework", in_week=True),
    Keyword("project", "practice", "project"),
    Keyword("projects", "practice", "project"),
    Keyword("lecture notes", "theory", "lecture_notes", whole=False),
)

#: Fixed value: the pattern of a day range and a month at the start of a title, such as "3 - 4 Octob".
DAY_RANGE = r"(?U)^\s*(\d{1,2})\s*-\s*\d{1,2}\s+([A-Za-z]+)"


@dataclass(frozen=True)
class CourseRules:
    """Everything that differs between courses. ``strict``: what cannot be read is an error; else it is null."""

    calendar: dict[str, int | None] = field(default_factory=lambda: dict(AUTUMN_2025))
    start: str = "2025-09-08"
    end: str = "2026-02-01"
    months: dict[str, int] = field(default_factory=lambda: dict(MONTHS))
    keywords: tuple[Keyword, ...] = KEYWORDS
    otherwise: tuple[str, str] = ("theory", "lecture_slides")
    homework: tuple[str, str] = ("practice", "homework")
    notes: tuple[str, str] = ("theory", "lecture_notes")
    solution: str = "solution"
    first_month: int = 6
    strict: bool = True

    @property
    def start_year(self) -> int:
        return int(self.start[:4])


def _map(pairs: dict, kind: str) -> Column:
    return F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), F.lit(v).cast(kind))])


def _fail(rules: CourseRules, value: Column, message: Column, kind: str) -> Column:
    return F.coalesce(value, F.raise_error(message).cast(kind)) if rules.strict else value


def title_text(kind: Column, section_title: Column, title: Column) -> Column:
    """What keywords are looked for in: section title and title of a learning-platform row, else the title, lower-cased."""
    both = F.concat(F.lower(section_title), F.lit("\n"), F.lower(title))
    return F.when(F.coalesce(kind == LMS, F.lit(False)), both).otherwise(F.lower(title))


def infer_date(kind: Column, section_title: Column, title: Column, rules: CourseRules) -> Column:
    """The day that the title starts with, within the semester; the semester's start where it has none.

    Months from ``first_month`` on belong to the year of the start, earlier ones to the next.
    """
    text = F.when(F.coalesce(kind == LMS, F.lit(False)), section_title).otherwise(F.lower(title))
    day, word = F.regexp_extract(text, DAY_RANGE, 1), F.regexp_extract(text, DAY_RANGE, 2)
    short = F.lower(F.substring(word, 1, 3))
    # the year follows from the month, so one lookup gives both; each part is evaluated once
    months = {m: f"{rules.start_year + (n < rules.first_month)}-{n}-" for m, n in rules.months.items()}
    month = _fail(rules, F.try_element_at(_map(months, "string"), short), F.concat(F.lit("no month: "), short), "string")
    found = F.try_to_date(F.concat(month, day), "yyyy-M-d")
    found = _fail(rules, found, F.concat(F.lit("no such day: "), day, F.lit(" "), word), "date")
    low, high = F.lit(dt.date.fromisoformat(rules.start)), F.lit(dt.date.fromisoformat(rules.end))
    clamped = F.greatest(F.least(found, high), low) if rules.strict else F.when(found < low, low).when(found > high, high).otherwise(found)
    return F.when(F.coalesce(word != "", F.lit(False)), clamped).otherwise(low)


def infer_week(date: Column, rules: CourseRules) -> Column:
    """The teaching week of a date; null in the break and off the calendar. The calendar is a literal, so no join is needed."""
    return F.try_element_at(_map(rules.calendar, "int"), date.cast("string"))


def infer_year(title: Column) -> Column:
    """All years 1000 to 2999 in the title, in order, joined by hyphens; null if there is none."""
    found = F.regexp_extract_all(F.lower(title), F.lit(r"(?U)\b(1[0-9]{3}|2[0-9]{3})\b"), 1)
    return F.nullif(F.array_join(found, "-"), F.lit(""))


def classify(text: Column, week: Column, rules: CourseRules) -> Column:
    """``struct(type, subtype)`` by the first keyword that fits."""
    pair = lambda a, b: F.struct(F.lit(a).alias("type"), F.lit(b).alias("subtype"))
    in_week = F.coalesce(week != 0, F.lit(False))
    out = None
    for k in rules.keywords:
        fits = text.rlike(rf"(?iU)\b{k.word}\b") if k.whole else F.contains(text, F.lit(k.word))
        fits = fits & in_week if k.in_week else fits
        value = pair(k.type, k.subtype)
        out = F.when(fits, value) if out is None else out.when(fits, value)
    last = pair(*rules.otherwise)
    return last if out is None else out.otherwise(last)


def is_solution(text: Column, rules: CourseRules) -> Column:
    """Whether the word occurs, also within another."""
    return F.coalesce(F.contains(text, F.lit(rules.solution)), F.lit(False))


def processing_method(mime_type: Column, kind: Column, rules: CourseRules) -> Column:
    """How a PDF is to be processed; null for anything else."""
    notes = kind == F.struct(F.lit(rules.notes[0]).alias("type"), F.lit(rules.notes[1]).alias("subtype"))
    return F.when(F.coalesce(mime_type == PDF, F.lit(False)), F.when(notes, "google").otherwise("gemini"))


def number(week: Column, year: Column) -> Column:
    """The week, else the years, as text."""
    return F.coalesce(F.when(week != 0, week.cast("string")), year)


def shifted_date(date: Column, rules: CourseRules) -> Column:
    """The next teaching day in the calendar; a week after the last; other dates stay."""
    days = [d for d, w in rules.calendar.items() if w]
    week = dt.timedelta(weeks=1)
    after = dict(zip(days, [*days[1:], *[str(dt.date.fromisoformat(d) + week) for d in days[-1:]]]))
    if not after:
        return date
    return F.coalesce(F.try_element_at(_map(after, "string"), date.cast("string")).cast("date"), date)


def from_field(date: Column, kind: Column, rules: CourseRules) -> Column:
    """When homework opens, as a timestamp with microseconds; null for anything else."""
    homework = kind == F.struct(F.lit(rules.homework[0]).alias("type"), F.lit(rules.homework[1]).alias("subtype"))
    return F.when(date.isNotNull() & homework, F.concat(date.cast("string"), F.lit("T00:00:00.000000")))
