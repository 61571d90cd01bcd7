"""Course fields from a page's title, heading, visible text and address."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import column, first_group, strip

# Fixed patterns of the progress bar and the login page.
PROGRESS_PATTERN = r"(?U)수강률\s*(\d+(?:\.\d+)?)\s*%"
STUDY_PATTERN = r"(?U)수강시간\s*(\d+):(\d+)(?::(\d+))?"
TOTAL_PATTERN = r"(?U)강의시간\s*(\d+):(\d+):(\d+)"
LOGIN_TITLE = "인증"
LOGIN_PATH = "sign-in"


def course_title(page_title, h1, course_id) -> Column:
    """Title from the page title, from the heading when that is shorter than 10, else a placeholder."""
    title, heading = column(page_title), column(h1)
    after_dash = F.when(
        title.contains(" - "), F.substring(title, F.instr(title, " - ") + 3, F.length(title))
    )
    named = strip(F.coalesce(after_dash, F.when(title.contains("|"), F.substring_index(title, "|", 1))))
    named = F.when(
        (F.coalesce(F.length(named), F.lit(0)) < 10) & (F.length(heading) > 10), strip(heading)
    ).otherwise(named)
    return F.when(
        F.coalesce(F.length(named), F.lit(0)) < 5, strip(F.concat(F.lit("Course "), column(course_id)))
    ).otherwise(named)


def _number(text: Column, pattern: str, group: int = 1) -> Column:
    return first_group(text, pattern, group).try_cast("double")


def progress_rate(body_text) -> Column:
    return F.coalesce(_number(column(body_text), PROGRESS_PATTERN), F.lit(0.0))


def study_minutes(body_text) -> Column:
    """h:m:s, or m:s when there are two parts; seconds rounded to two places of a minute."""
    a, b, s = (_number(column(body_text), STUDY_PATTERN, i) for i in (1, 2, 3))
    return F.coalesce(a * 60 + b + F.round(s / 60, 2), a + F.round(b / 60, 2), F.lit(0.0))


def total_minutes(body_text) -> Column:
    """h:m:s, seconds not rounded."""
    h, m, s = (_number(column(body_text), TOTAL_PATTERN, i) for i in (1, 2, 3))
    return F.coalesce(h * 60 + m + s / 60, F.lit(0.0))


def is_authenticated(page_title, url) -> Column:
    """False (or NULL, which a filter drops too) for login pages."""
    return ~column(page_title).contains(LOGIN_TITLE) & ~column(url).contains(LOGIN_PATH)
