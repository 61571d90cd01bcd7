import pytest

from coursepulse.functions import durations, links, page_fields
from pyspark.sql import functions as F

# text: daily, full, strict
DURATIONS = {
    None: (0.0, 0.0, None),
    "": (0.0, 0.0, None),
    "30분": (30.0, 30.0, 30.0),
    "1시간": (60.0, 60.0, 60.0),
    "1시간 30분": (90.0, 90.0, 90.0),
    "2 시간 뒤": (120.0, 120.0, 120.0),
    "25:50": (25.83, 1550.0, 25.83),
    "25:20": (25.33, 1520.0, 25.33),
    "61:30": (61.5, 61.5, 61.5),
    "60:30": (60.5, 3630.0, 60.5),
    "1:30:45": (90.75, 90.75, 90.75),
    "2:46:10": (166.17, 166 + 10 / 60, 166.17),
    " 46:10 ": (46.17, 2770.0, 46.17),
    "1:2:3:4": (0.0, 0.0, None),
    "45": (0.0, 0.0, 45.0),
    "abc": (0.0, 0.0, None),
    "a:b": (0.0, 0.0, None),
    "1:x:3": (0.0, 0.0, None),
    "0:00": (0.0, 0.0, None),
    "x시간": (0.0, 0.0, None),
    "10분:": (0.0, 0.0, None),
    "1시간 5분 : 2분:3:4": (65.0, 65.0, None),
    "-5": (0.0, 0.0, None),
}


def test_durations(spark):
    df = spark.createDataFrame([(k,) for k in DURATIONS], "s STRING")
    rows = df.select(
        "s", durations.parse_duration_daily("s"), durations.parse_duration_full("s"),
        durations.parse_duration_strict("s"), durations.duration_rejected("s"),
    ).collect()
    for s, daily, full, strict, rejected in rows:
        want = DURATIONS[s]
        if rejected:  # malformed clocks count as 0
            assert (daily, full) == (0.0, 0.0), s
        else:
            assert daily == pytest.approx(want[0]) and full == pytest.approx(want[1]), s
        assert strict == pytest.approx(want[2]) if want[2] is not None else strict is None, s
    assert {r[0] for r in rows if r[4]} == {"a:b", "1:x:3", "10분:"}


def test_course_ids_disagree_on_purpose(spark):
    cases = {
        "https://x/classroom/214390": ("214390", 214390),
        "https://x/classroom/12?x=1": ("12", None),
        "https://x/classroom/12/": ("12/", 12),
        "https://x/classroom/12///": ("12///", 12),
        "https://x/classroom/a/classroom/7?b?c": ("7", None),
        "https://x/other/9": ("https://x/other/9", 9),
        "https://x/classroom/x12": ("x12", None),
        "": ("", None),
        None: (None, None),
    }
    df = spark.createDataFrame([(k,) for k in cases], "u STRING")
    got = df.select("u", links.course_id_from_classroom("u"), links.course_id_from_path("u")).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == cases


def test_course_link(spark):
    rows = [
        ("/classroom/5", None, None, None, "https://s/classroom/5"),
        ("https://o/classroom/6", "9", None, None, "https://o/classroom/6"),
        ("/me/courses", "", "8", "7", "https://s/classroom/8"),
        (None, "", "", "7", "https://s/classroom/7"),
        (None, None, "", None, None),
    ]
    df = spark.createDataFrame(rows, "h STRING, a STRING, b STRING, c STRING, want STRING")
    for r in df.select("want", links.course_link("h", "a", "b", "c", "https://s").alias("got")).collect():
        assert r.got == r.want


def test_course_title(spark):
    rows = [
        ("Site - A title that is long", "", "A title that is long"),
        ("Site - one - two and more", "", "one - two and more"),
        ("A good long title | Site", "", "A good long title"),
        ("Site - abcd", "short", "Course 9"),
        ("Site - abcde", "1234567890", "abcde"),
        ("Site - abcdefghi", "12345678901", "12345678901"),
        ("Site - abcdefghij", "12345678901", "abcdefghij"),
        ("no separator here", None, "Course 9"),
        ("no separator here", "  heading long  ", "heading long"),
        ("Site - \t padded title \n", None, "padded title"),
        ("", "", "Course 9"),
    ]
    df = spark.createDataFrame(rows, "t STRING, h STRING, want STRING")
    for r in df.select("t", "want", page_fields.course_title("t", "h", F.lit("9")).alias("got")).collect():
        assert r.got == r.want, r.t


def test_page_metrics(spark):
    rows = [
        ("수강률 45.5% 수강시간 1:30:45 강의시간 23:08:50", 45.5, 90.75, 23 * 60 + 8 + 50 / 60),
        ("수강률\n7 %\n수강시간\n12:30", 7.0, 12.5, 0.0),
        ("강의시간 1:30", 0.0, 0.0, 0.0),
        ("수강률 1% 수강률 2%", 1.0, 0.0, 0.0),
        ("", 0.0, 0.0, 0.0),
        (None, 0.0, 0.0, 0.0),
    ]
    df = spark.createDataFrame(rows, "b STRING, p DOUBLE, s DOUBLE, t DOUBLE")
    got = df.select("p", "s", "t", page_fields.progress_rate("b"), page_fields.study_minutes("b"),
                    page_fields.total_minutes("b")).collect()
    for r in got:
        assert tuple(r[:3]) == pytest.approx(tuple(r[3:]))


def test_login_pages_and_untitled_pages_are_dropped(spark):
    df = spark.createDataFrame(
        [(1, "ok", "https://x/classroom/1"), (2, "인증 확인", "https://x"), (3, "ok", "https://x/sign-in"),
         (4, None, "https://x"), (5, "ok", None)], "i INT, t STRING, u STRING")
    assert [r.i for r in df.filter(page_fields.is_authenticated("t", "u")).collect()] == [1]
