from coursepulse.operators import completions as d
from coursepulse.operators import selection

from .conftest import values


def test_day_bounds(lectures, courses):
    df = lectures(
        (1, 1, None, 1, 10.0, "2024-03-01 00:00:00"), (1, 1, None, 2, 20.0, "2024-03-01 23:59:59"),
        (1, 1, None, 3, 40.0, "2024-02-29 23:59:59"), (1, 1, None, 4, 80.0, "2024-03-02 00:00:00"),
        (9, 1, None, 5, 5.0, "2024-03-01 12:00:00"))
    titles = courses((1, 0.0, 9.0))
    assert [r.lecture_title for r in d.completed_today(df, titles, "2024-03-01").collect()] == ["Lecture 2", "Lecture 1"]
    assert [r.completed_time for r in d.completed_on(df, titles, "2024-03-01").collect()] == ["00:00:00", "23:59:59"]
    assert tuple(d.completed_today_stats(df, "2024-03-01").first()) == (3, 35.0, 0.58)
    assert values(d.completed_today_by_course(df, titles, "2024-03-01")) == [("Course no 1", 2, 30.0, 0.5)]


def test_empty_day(lectures):
    df = lectures((1, 1, None, 1, 10.0, "2024-03-01 00:00:00"))
    assert tuple(d.completed_today_stats(df, "2024-04-01").first()) == (0, None, None)
    assert values(d.today_vs_yesterday(df, "2024-04-01")) == [("어제", 0, None), ("오늘", 0, None)]
    assert values(d.today_vs_yesterday(df, "2024-03-02")) == [("어제", 1, 0.17), ("오늘", 0, None)]


def test_leap_month(lectures):
    df = lectures(*[(1, 1, None, n, 60.0, f"2024-02-{n:02d} 10:00:00") for n in range(1, 30)],
                  (1, 1, None, 30, 60.0, "2024-03-01 00:00:00"), (1, 1, None, 31, 60.0, "2023-02-05 00:00:00"))
    assert tuple(d.month_stats(df, "2024-02-29").first()) == (29, 29 * 60.0, 29.0, 1.0)


def test_a_replayed_day_sees_nothing_later(lectures, courses):
    df = lectures(*[(1, 1, None, n, 60.0, f"2024-01-{n:02d} 10:00:00") for n in (5, 10, 20)])
    assert d.month_stats(df, "2024-01-10").first().lecture_count == 2
    titles = courses((1, 0.0, 9.0))
    assert [r.lecture_title for r in d.recent_completed(df, titles, as_of="2024-01-10").collect()] == ["Lecture 10", "Lecture 5"]
    assert [r.lecture_title for r in d.recent_completed_per_course(df, titles, 1, as_of="2024-01-10").collect()] == ["Lecture 10"]


def test_last_seven_days_are_eight_dates(lectures):
    df = lectures(*[(1, 1, None, n, 1.0, f"2024-03-{n:02d} 10:00:00") for n in range(1, 20)])
    rows = d.daily_stats_7d(df, "2024-03-10").collect()
    assert [r.completed_date.day for r in rows] == list(range(10, 2, -1))
    assert rows[0].day_name == "Sunday"


def test_recent_completed_takes_the_lowest_courses(lectures, courses):
    rows = [(c, 1, None, n, 1.0, f"2024-03-{n:02d} 10:00:00") for c in (1, 2, 3, 5) for n in range(1, 5)]
    df, titles = lectures(*rows), courses((2, 0.0, 9.0), (3, 0.0, 9.0), (4, 0.0, 9.0), (5, 0.0, 9.0))
    got = [(r.course_title, r.lecture_title) for r in d.recent_completed(df, titles, 6).collect()]
    assert got == [("Course no 2", f"Lecture {n}") for n in (4, 3, 2, 1)] + [("Course no 3", f"Lecture {n}") for n in (4, 3)]
    per = d.recent_completed_per_course(df, titles, 2).collect()
    assert [(r.course_id, r.rank, r.lecture_title) for r in per] == [
        (c, k, f"Lecture {5 - k}") for c in (2, 3, 5) for k in (1, 2)]


def test_coverage_audit_bound_is_strict(lectures, courses):
    titles = courses((1, 0.0, 100.0), (2, 0.0, 100.0), (3, 0.0, 0.0), (4, 0.0, 100.0, None), (5, 0.0, 100.0),
                     (6, 0.0, 100.0))
    df = lectures((1, 1, None, 1, 90.0, None), (2, 1, None, 1, 89.0, None), (3, 1, None, 1, 50.0, None),
                  (6, 1, None, 1, 80.0, None), (6, 1, None, 2, 31.0, None))
    rows = selection.coverage_audit(titles, df).collect()
    assert [(r.course_id, r.actual_time, r.diff) for r in rows] == [(5, 0.0, 100.0), (2, 89.0, 11.0), (6, 111.0, -11.0)]


def test_courses_to_update(courses):
    df = courses((1, 0.0, 9.0, "u1", "2024-03-09 00:00:00"), (2, 0.0, 9.0, "u2", "2024-03-08 11:59:59"),
                 (3, 0.0, 9.0, "u3", None), (4, 0.0, 9.0, None, None))
    def ids(**options):
        return sorted(r.course_id for r in selection.courses_to_update(df, **options).collect())
    assert ids() == [1, 2, 3]
    assert ids(target_only=True) == [1, 3]
    assert ids(skip_recent=True, as_of="2024-03-09 12:00:00") == [2, 3]
    assert ids(target_only=True, skip_recent=True, as_of="2024-03-09 12:00:00") == [3]
    assert ids(course_id=2, target_only=True, skip_recent=True) == [2]
