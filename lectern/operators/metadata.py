"""Infer all metadata of resource rows, in the order in which the fields depend on each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import rules as R
from lectern.schema import copy_with


def infer_metadata(df: DataFrame, rules: R.CourseRules | None = None) -> DataFrame:
    """``df`` with date, week, year, type, subtype, solution flag, processing method, number and opening time.

    Week and number follow the unshifted date; the opening time follows the shifted one. One projection, no shuffle.
    """
    rules = rules or R.CourseRules()
    df = df.withColumn("__text", R.title_text(F.col("kind"), F.col("section_title"), F.col("title")))  # computed once for all keywords
    text = F.col("__text")
    df = copy_with(df, date=R.infer_date(F.col("kind"), F.col("section_title"), F.col("title"), rules), year=R.infer_year(F.col("title")))
    df = copy_with(df, week=R.infer_week(F.col("date"), rules))
    df = df.withColumn("__kind", R.classify(text, F.col("week"), rules))
    df = copy_with(
        df,
        type=F.col("__kind.type"),
        subtype=F.col("__kind.subtype"),
        is_solution=R.is_solution(text, rules),
        processing_method=R.processing_method(F.col("mime_type"), F.col("__kind"), rules),
        number=R.number(F.col("week"), F.col("year")),
    )
    homework = (F.col("type") == rules.homework[0]) & (F.col("subtype") == rules.homework[1])
    df = copy_with(df, date=F.when(homework & F.col("is_solution"), R.shifted_date(F.col("date"), rules)).otherwise(F.col("date")))
    df = copy_with(df, from_=R.from_field(F.col("date"), F.col("__kind"), rules))
    return df.drop("__kind", "__text")
