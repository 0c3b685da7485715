"""Rules that are data give what rules held in Python give, for several courses in one job."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lectern.functions import rules as R
from lectern.functions.paths import MARKDOWN, PDF
from lectern.operators.metadata import infer_metadata
from lectern.operators.rule_tables import infer_by_course, rules_table
from lectern.schema import LMS, as_resources, check_schema

OTHER = R.CourseRules(
    calendar={"2025-10-01": 1, "2025-10-08": 0, "2025-11-12": None, "2025-11-19": 4}, start="2025-08-20", end="2025-12-01", first_month=8,
    keywords=(R.Keyword("note", "theory", "n", whole=False), R.Keyword("sheet", "practice", "s", in_week=True)), otherwise=("o", "o"),
    homework=("practice", "s"), notes=("theory", "n"), solution="key", strict=False, months={"oct": 10, "nov": 11, "jan": 1},
)
TITLES = ["8 - 9 October sheet key", "1 - 2 Octob Solution", " 19 - 20 nov sheet", "19-20 nov sheet key", "exam 2018-2019", "Lecture notes", "homework solution", "no date",
          "10 - 16 Jan problem", "3 - 4 Dec projects", "12 - 13 Nov sheet", "1 - 1 oct key sheet", "", "x1999 2001"]


def rows(spark):
    df = spark.createDataFrame([(i, t, k, m) for i, (t, k, m) in enumerate((t, k, m) for t in TITLES for k in (LMS, None) for m in (PDF, MARKDOWN))], "id long, title string, kind string, mime_type string")
    return as_resources(df, source=F.lit("s"), url=F.lit("u"), path=F.lit("/p"), section_title=F.col("title"))


def test_each_course_equals_its_rules_in_python(spark):
    courses = {"autumn": replace(R.CourseRules(), strict=False), "other": OTHER}
    table = rules_table(spark, courses)
    both = rows(spark).withColumn("chapter", F.lit("autumn")).unionByName(rows(spark).withColumn("chapter", F.lit("other")))
    got = check_schema(infer_by_course(both, table, F.col("chapter")))
    for name, rules in courses.items():
        want = infer_metadata(rows(spark), rules).withColumn("chapter", F.lit(name))
        assert sorted(map(str, got.where(F.col("chapter") == name).collect())) == sorted(map(str, want.collect()))


def test_strict_courses_and_unknown_ones(spark):
    table = rules_table(spark, {"a": R.CourseRules()})
    odd = rows(spark).limit(1).withColumn("section_title", F.lit("3 - 4 août"))
    with pytest.raises(Exception, match="no month"):
        infer_by_course(odd, table, F.lit("a")).collect()
    with pytest.raises(Exception, match="no rules for course b"):
        infer_by_course(odd, table, F.lit("b")).collect()
    assert infer_by_course(odd.limit(0), table, F.lit("a")).count() == 0
