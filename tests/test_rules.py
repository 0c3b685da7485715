import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lectern.functions import rules as R
from lectern.operators.metadata import infer_metadata
from lectern.schema import METADATA_FIELDS, as_resources, check_schema, copy_with, metadata

START = dt.date(2025, 9, 8)
RULES = R.CourseRules()


def infer(spark, rows, rules=RULES):
    """rows: (kind, section title, title, mime type)."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, kind string, section_title string, title string, mime_type string")
    full = as_resources(df, source=F.lit("s"), url=F.lit("u"), path=F.lit("p"), ord=F.array(F.col("id").cast("int")))
    return infer_metadata(full, rules).orderBy("id").collect()


def lms(section, title="t", mime=None):
    return ("moodle", section, title, mime)


DATES = [
    ("3 - 4 Octob", dt.date(2025, 10, 3)), (" 15-16  Oct more", dt.date(2025, 10, 15)), ("no date", START), ("3 – 4 Octob", START),
    ("10 - 16 December", dt.date(2025, 12, 10)), ("1 - 2 March", dt.date(2026, 2, 1)), ("5 - 6 jan", dt.date(2026, 1, 5)), ("1 - 2 juin", START),
    ("see 3 - 4 Oct", START), (" 3 - 4 oct", dt.date(2025, 10, 3)), ("3 - 4 Octob 5 - 6 nov", dt.date(2025, 10, 3)),
]


def test_dates(spark):
    got = infer(spark, [lms(t) for t, _ in DATES])
    assert [r.date for r in got] == [d for _, d in DATES]
    other = infer(spark, [(None, "3 - 4 Octob", "17 - 18 SEP exam", None), ("mooc", None, "17 - 18 SEP", None)])
    assert [(r.date, r.week) for r in other] == [(dt.date(2025, 9, 17), 2)] * 2


@pytest.mark.parametrize("text", ["1 - 2 things", "3 - 4 août", "3 - 4 févr", "31 - 31 sep", "29 - 29 feb"])
def test_unreadable_dates(spark, text):
    with pytest.raises(Exception, match="no month|no such day"):
        infer(spark, [lms(text)])
    assert infer(spark, [lms(text)], replace(RULES, strict=False))[0].date is None


CASES = [
    # section, title, type, subtype, solution, week, number, opens
    ("Exam 2018", "x", "exam", "previous_year_exam", False, None, None, None),
    ("s", "exam 2018", "exam", "previous_year_exam", False, None, "2018", None),
    ("s", "examen 2018", "theory", "lecture_slides", False, None, "2018", None),
    ("s", "exam_2018", "theory", "lecture_slides", False, None, None, None),
    ("s", "2018-2019 EXAMS", "exam", "previous_year_exam", False, None, "2018-2019", None),
    ("s", "resolution 2999 3000", "theory", "lecture_slides", True, None, "2999", None),
    ("s", "solution 1", "theory", "lecture_slides", True, None, None, None),
    ("15 - 16 Oct", "solution 1", "practice", "homework", True, 6, "6", "2025-10-29T00:00:00.000000"),
    ("17 - 18 Dec", "Solutions", "practice", "homework", True, 14, "14", "2025-12-24T00:00:00.000000"),
    ("22 - 23 Oct", "problem", "theory", "lecture_slides", False, None, None, None),
    ("8 - 9 Oct", "Problems 2024", "practice", "homework", False, 5, "5", "2025-10-08T00:00:00.000000"),
    ("s", "homework", "practice", "homework", False, None, None, "2025-09-08T00:00:00.000000"),
    ("s", "homework solution", "practice", "homework", True, None, None, "2025-09-08T00:00:00.000000"),
    ("s", "The project.", "practice", "project", False, None, None, None),
    ("s", "projects", "practice", "project", False, None, None, None),
    ("Lecture notes", "x", "theory", "lecture_notes", False, None, None, None),
    ("s", "prelecture notes2", "theory", "lecture_notes", False, None, None, None),
    ("s", "éexam", "theory", "lecture_slides", False, None, None, None),
]


def test_classification(spark):
    got = infer(spark, [lms(c[0], c[1]) for c in CASES])
    assert [(r.type, r.subtype, r.is_solution, r.week, r.number, r.from_) for r in got] == [c[2:] for c in CASES]


def test_processing_method(spark):
    pdf = "application/pdf"
    got = infer(spark, [lms("s", "lecture notes", pdf), lms("s", "x", pdf), lms("s", "lecture notes", "text/markdown"), lms("s", "x")])
    assert [r.processing_method for r in got] == ["google", "gemini", None, None]


def test_schema(spark):
    df = as_resources(spark.range(1), title=F.lit("t"), source=F.lit("s"), url=F.lit("u"), path=F.lit("p"))
    check_schema(df)
    assert [c.rstrip("_") for c in METADATA_FIELDS] == metadata(df).columns and len(metadata(df).columns) == 23
    row = df.first()
    assert row.mime_type is None and row.is_solution is False and row.week is None
    assert copy_with(df, title=F.lit("x")).first().title == "x"
    for bad in (lambda: copy_with(df, nothing=F.lit(1)), lambda: check_schema(df.drop("week")), lambda: as_resources(spark.range(1), title=F.lit("t"))):
        with pytest.raises(TypeError):
            bad()
