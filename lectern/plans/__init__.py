"""Pipelines by name."""

from lectern.plans.courses import course
from lectern.plans.pipeline import Pipeline, available, from_name, register

__all__ = ["Pipeline", "available", "course", "from_name", "register"]
