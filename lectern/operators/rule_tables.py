"""Metadata inference by rules that are data: a table with a row for each course, so that one job serves many courses."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import rules as R
from lectern.functions.paths import PDF
from lectern.schema import LMS, copy_with

_PAIR = "struct<type: string, subtype: string>"
#: A course's rules: what ``functions.rules.CourseRules`` holds, as columns. The calendar gives a teaching day's week, none in a break.
RULES = f"""
    course string, calendar map<date, int>, first_day date, last_day date, months map<string, int>, first_month int,
    keywords array<struct<word: string, type: string, subtype: string, whole: boolean, in_week: boolean>>,
    otherwise {_PAIR}, homework {_PAIR}, notes {_PAIR}, solution string, strict boolean
"""


def rules_table(spark: SparkSession, courses: Mapping[str, R.CourseRules]) -> DataFrame:
    """Rules held in Python as such a table; other tables of the form ``RULES``, from wherever, serve as well."""
    day = dt.date.fromisoformat
    rows = [
        (name, {day(d): w for d, w in r.calendar.items()}, day(r.start), day(r.end), r.months, r.first_month,
         [(k.word, k.type, k.subtype, k.whole, k.in_week) for k in r.keywords], r.otherwise, r.homework, r.notes, r.solution, r.strict)
        for name, r in courses.items()
    ]
    return spark.createDataFrame(rows, RULES)


def _or_error(value: Column, strict: Column, message: Column, kind: str) -> Column:
    return F.coalesce(value, F.when(strict, F.raise_error(message).cast(kind)))


def infer_by_course(df: DataFrame, rules: DataFrame, course: Column) -> DataFrame:
    """``infer_metadata`` of each row by the rules of its ``course``; a course that the table does not have is an error.

    One join, then one projection. Keywords are tried in the table's order, the first that fits counts; dates are clamped to the course's days, and what
    cannot be read is an error for a strict course, else null, as with rules held in Python.
    """
    own = [f"__{c}" for c in rules.columns]
    rows = df.withColumn("__course", course).join(rules.toDF(*own).withColumn("__there", F.lit(True)), "__course", "left")
    r = {c: F.col(f"__{c}") for c in rules.columns}
    known = F.when(F.col("__there"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no rules for course "), F.coalesce("__course", F.lit("null")))).cast("boolean"))
    rows = rows.where(known)

    kind, title = F.col("kind"), F.col("title")
    dated = F.when(F.coalesce(kind == LMS, F.lit(False)), F.col("section_title")).otherwise(F.lower(title))
    day, word = F.regexp_extract(dated, R.DAY_RANGE, 1), F.regexp_extract(dated, R.DAY_RANGE, 2)
    rows = rows.withColumns({"__text": R.title_text(kind, F.col("section_title"), title), "__day": day, "__word": word})
    short = F.lower(F.substring("__word", 1, 3))
    month = _or_error(F.try_element_at(r["months"], short), r["strict"], F.concat(F.lit("no month: "), short), "int")
    rows = rows.withColumn("__month", F.when(F.col("__word") != "", month))
    year = F.year(r["first_day"]) + (F.col("__month") < r["first_month"]).cast("int")
    found = F.try_to_date(F.concat_ws("-", year, "__month", "__day"), "yyyy-M-d")
    found = _or_error(found, r["strict"], F.concat(F.lit("no such day: "), F.col("__day"), F.lit(" "), F.col("__word")), "date")
    rows = rows.withColumn("__found", F.when(F.col("__word") != "", found))
    clamped = F.when(F.col("__found").isNotNull(), F.greatest(F.least("__found", r["last_day"]), r["first_day"]))
    date = F.when(F.coalesce(F.col("__word") != "", F.lit(False)), clamped).otherwise(r["first_day"])
    rows = copy_with(rows, date=date, year=R.infer_year(title))
    rows = copy_with(rows, week=F.try_element_at(r["calendar"], F.col("date")))

    in_week = F.coalesce(F.col("week") != 0, F.lit(False))

    def fits(k: Column) -> Column:
        there = F.when(k["whole"], F.rlike(F.col("__text"), F.concat(F.lit(r"(?iU)\b"), k["word"], F.lit(r"\b")))).otherwise(F.contains(F.col("__text"), k["word"]))
        return F.coalesce(there & (~k["in_week"] | in_week), F.lit(False))

    first = F.get(F.filter(r["keywords"], fits), F.lit(0))
    pair = F.struct(first["type"].alias("type"), first["subtype"].alias("subtype"))
    rows = rows.withColumn("__kind", F.coalesce(F.when(first.isNotNull(), pair), r["otherwise"]))
    solved = F.coalesce(F.contains(F.col("__text"), r["solution"]), F.lit(False))
    method = F.when(F.coalesce(F.col("mime_type") == PDF, F.lit(False)), F.when(F.col("__kind") == r["notes"], "google").otherwise("gemini"))
    rows = copy_with(rows, type=F.col("__kind.type"), subtype=F.col("__kind.subtype"), is_solution=solved, processing_method=method, number=R.number(F.col("week"), F.col("year")))

    # the next teaching day of the calendar, a week after its last
    days = F.array_sort(F.map_keys(F.map_filter(r["calendar"], lambda d, w: F.coalesce(w != 0, F.lit(False)))))
    at = F.array_position(days, F.col("date")).cast("int")
    after = F.when(at > 0, F.coalesce(F.get(days, at), F.date_add("date", 7))).otherwise(F.col("date"))
    homework = F.col("__kind") == r["homework"]
    rows = copy_with(rows, date=F.when(homework & F.col("is_solution"), after).otherwise(F.col("date")))
    opens = F.when(F.col("date").isNotNull() & homework, F.concat(F.col("date").cast("string"), F.lit("T00:00:00.000000")))
    return copy_with(rows, from_=opens).select(*df.columns)
