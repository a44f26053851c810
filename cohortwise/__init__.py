"""Cohort curation and concept reporting on Spark DataFrames."""

from cohortwise.functions.study import DEFAULT_WINDOW, StudyWindow

__all__ = ["DEFAULT_WINDOW", "StudyWindow"]
