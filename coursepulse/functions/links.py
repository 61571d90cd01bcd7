"""Course links and the two rules that read a course id from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import column, whole_number

# Fixed path segment in front of the course id.
CLASSROOM_PATH = "/classroom/"


def course_id_from_classroom(url: Column | str) -> Column:
    """Text after the last classroom segment up to a query string; the whole url without one."""
    return F.substring_index(F.substring_index(column(url), CLASSROOM_PATH, -1), "?", 1)


def course_id_from_path(url: Column | str) -> Column:
    """Last path segment as an integer when it is all digits, else NULL; trailing slashes ignored.

    Deliberately different from ``course_id_from_classroom``: a query string makes this one NULL,
    a trailing slash makes the other one non-numeric.
    """
    tail = F.substring_index(F.regexp_replace(column(url), "/+$", ""), "/", -1)
    return F.when(tail.rlike(r"^\d+$"), whole_number(tail))


def course_link(href, data_course_id, data_id, data_key, site: str) -> Column:
    """Link of one listing box: the href if it is a classroom link, else built from a data attribute.

    NULL when neither leads to a classroom link. Relative links get ``site`` in front.
    """
    href = column(href)
    linked = F.when(
        href.contains(CLASSROOM_PATH),
        F.when(href.startswith("/"), F.concat(F.lit(site), href)).otherwise(href),
    )
    key = F.coalesce(*(F.nullif(column(c), F.lit("")) for c in (data_course_id, data_id, data_key)))
    return F.coalesce(linked, F.concat(F.lit(site + CLASSROOM_PATH), key))
