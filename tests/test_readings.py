import pytest

from coursepulse.operators import extraction, markup
from coursepulse.plans import collect
from coursepulse.plans.readings import StoredReadings

from .test_extraction import CLASSROOM

PAGES = "page_id BIGINT, url STRING, html STRING"


def archive(spark, rows):
    return spark.createDataFrame([(i, f"https://x/classroom/{i}", html) for i, html in rows], PAGES)


@pytest.fixture
def parsed(monkeypatch, tmp_path):
    """The markup handed to the parser so far, one line per call, in whichever process."""
    calls = tmp_path / "calls"
    calls.touch()
    path = str(calls)

    class Counted(markup.Page):
        def __init__(self, html):
            with open(path, "a") as file:
                file.write(f"{html[-20:]!r}\n")
            super().__init__(html)

    monkeypatch.setattr(markup, "Page", Counted)
    return lambda: calls.read_text().splitlines()


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_only_changed_markup_is_parsed(spark, tmp_path, parsed):
    first = archive(spark, [(i, CLASSROOM + f"<p>{i}</p>") for i in range(12)])
    readings = StoredReadings(spark, str(tmp_path / "store"))
    readings.add(first)
    assert len(parsed()) == 12
    readings.add(first)
    assert rows_of(readings.extract(first)) and len(parsed()) == 12
    # Two pages changed, one is new, one went back to another page's markup.
    second = archive(spark, [(i, CLASSROOM + f"<p>{i}{'new' if i in (3, 5) else ''}</p>") for i in range(1, 13)] + [(20, CLASSROOM + "<p>0</p>")])
    got = rows_of(readings.extract(second))
    assert sorted(parsed()[12:]) == sorted(repr((CLASSROOM + f"<p>{x}</p>")[-20:]) for x in ("3new", "5new", "12"))
    assert got == rows_of(extraction.extract_pages(second))


def test_shared_markup_repeated_pages_and_pages_without_any(spark, tmp_path, parsed):
    pages = archive(spark, [(i, CLASSROOM) for i in range(40)] + [(7, CLASSROOM), (50, None), (51, ""), (None, CLASSROOM), (None, "<p>x")])
    readings = StoredReadings(spark, str(tmp_path / "store"))
    got = rows_of(readings.extract(pages))
    assert len(parsed()) <= 4 and readings.read().select("digest").distinct().count() == 3
    assert got == rows_of(extraction.extract_pages(pages))
    assert [r.rejected for r in readings.extract(pages, ("rejected",)).filter("page_id = 50").collect()] == ["no markup"]
    assert readings.extract(pages, ("h1",)).columns == ["page_id", "h1"]
    assert readings.extract(pages.limit(0)).count() == 0


def test_a_page_that_cannot_be_read_is_not_tried_again(spark, tmp_path, monkeypatch):
    class Broken(markup.Page):
        def __init__(self, html):
            raise ValueError("broken")

    monkeypatch.setattr(markup, "Page", Broken)
    readings = StoredReadings(spark, str(tmp_path / "store"))
    pages = archive(spark, [(1, "<p>a"), (2, "<p>b")])
    assert {r.rejected for r in readings.extract(pages).collect()} == {"ValueError: broken"}
    monkeypatch.undo()
    assert {r.rejected for r in readings.extract(pages).collect()} == {"ValueError: broken"}


def test_writers_beside_each_other_and_profiles(spark, tmp_path):
    root = str(tmp_path / "store")
    pages = archive(spark, [(1, CLASSROOM), (2, CLASSROOM + "<p>b</p>")])
    one, other = StoredReadings(spark, root), StoredReadings(spark, root)
    known = spark.createDataFrame([], one.read().schema)
    other.read = lambda: known  # has looked before the first one wrote
    one.add(pages)
    other.add(pages)
    assert one.read().count() == 4
    assert rows_of(one.extract(pages)) == rows_of(extraction.extract_pages(pages))
    flat = StoredReadings(spark, root, "classroom_flat")
    assert rows_of(collect.page_items(pages, "classroom_flat", readings=flat)) == rows_of(collect.page_items(pages, "classroom_flat"))
    assert rows_of(collect.page_items(pages, rejects=True, readings=one)) == rows_of(collect.page_items(pages, rejects=True))
    with pytest.raises(ValueError):
        collect.page_items(pages, readings=flat)
    with pytest.raises(ValueError):
        StoredReadings(spark, root, "nothing")


def test_readings_and_markup_are_not_sorted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("coursepulse.plans.readings.FEW_PAGES", 0)
    readings = StoredReadings(spark, str(tmp_path / "store"))
    pages = archive(spark, [(i, CLASSROOM + f"<p>{i}</p>") for i in range(12)] + [(50, None), (None, CLASSROOM)])
    read = readings.extract(pages)
    plan = read._sc._jvm.PythonSQLUtils.explainString(read._jdf.queryExecution(), "simple")
    assert "ShuffledHashJoin" in plan and "Sort" not in plan
    assert rows_of(read) == rows_of(extraction.extract_pages(pages))


def text(i, more=""):
    return CLASSROOM + f"<p>{i}{more}</p>"


def test_markup_does_not_move_to_tell_what_is_new(spark, tmp_path, monkeypatch):
    """Also where new pages are too many to be sent to the tasks."""
    from coursepulse.plans import readings as module

    plans = []

    def noted(pages, *args):
        plans.append(pages._sc._jvm.PythonSQLUtils.explainString(pages._jdf.queryExecution(), "simple"))
        return extraction.extract_pages(pages, *args)

    monkeypatch.setattr(module, "FEW_PAGES", 3)
    monkeypatch.setattr(module, "extract_pages", noted)
    readings = StoredReadings(spark, str(tmp_path / "store"))
    first = archive(spark, [(i, text(i)) for i in range(20)])
    second = archive(spark, [(i, text(i, "new" if i % 2 else "")) for i in range(20)])
    readings.add(first)
    assert rows_of(readings.extract(second)) == rows_of(extraction.extract_pages(second))
    assert len(plans) == 2 and not [plan for plan in plans if "Exchange hashpartitioning" in plan]


def test_a_sieve_that_lets_others_pass_changes_nothing(spark, tmp_path, parsed, monkeypatch):
    monkeypatch.setattr("coursepulse.plans.readings.FEW_PAGES", 0)
    monkeypatch.setattr("coursepulse.plans.readings.MOST_BITS", 8)
    readings = StoredReadings(spark, str(tmp_path / "store"))
    # The archive grows old twice, so most of what is stored belongs to no page.
    for turn in range(3):
        rows = [(i, text(i, turn if i % 3 else "")) for i in range(12)] + [(None, text("x", turn)), (None, text(1, turn)), (90, None), (91, text(1, turn))]
        pages = archive(spark, rows)
        before = len(parsed())
        got = rows_of(readings.extract(pages))
        # Two pages share the markup of page 1; of page 0, 3, 6 and 9 it stays.
        assert sorted(set(parsed()[before:])) == sorted({repr(html[-20:]) for i, html in rows if html and (turn == 0 or i is None or i % 3 or i == 91)})
        assert len(parsed()) - before == (13 if turn == 0 else 9)
        assert got == rows_of(extraction.extract_pages(pages))
    assert readings.read().count() == 31


def test_columns_made_of_readings(spark, tmp_path):
    from pyspark.sql import functions as F

    readings = StoredReadings(spark, str(tmp_path / "store"))
    pages = archive(spark, [(1, text(1)), (2, text(22)), (3, None)])
    read = readings.extract(pages, ("h1",), {"n": F.length("body_text")})
    assert read.columns == ["page_id", "h1", "n"]
    whole = extraction.extract_pages(pages, fields=("h1", "body_text")).select("page_id", "h1", F.length("body_text").alias("n"))
    assert rows_of(read) == rows_of(whole)


def test_what_was_just_read_does_not_move(spark, tmp_path, monkeypatch):
    """Pages that were parsed in the same call have their reading beside them; only readings of the others are joined."""
    from coursepulse.plans import readings as module

    joined = []
    real = module._pass
    monkeypatch.setattr(module, "_pass", lambda rows, *args: joined.append(real(rows, *args)) or joined[-1])
    readings = StoredReadings(spark, str(tmp_path / "store"))
    rows = [(i, f"https://x/{i}" if i % 2 else None, text(i)) for i in range(12)] + [(3, "https://y/3", text(3)), (13, "", text(13)), (14, "+", None)]
    first = spark.createDataFrame(rows, PAGES)
    assert rows_of(readings.extract(first)) == rows_of(extraction.extract_pages(first))
    assert joined.pop().count() == 0
    rows = [(i, url, html and html + ("new" if i in (2, 3) else "")) for i, url, html in rows] + [(20, "z", text(1))]
    second = spark.createDataFrame(rows, PAGES)
    assert rows_of(readings.extract(second)) == rows_of(extraction.extract_pages(second))
    assert {r.digest for r in joined.pop().collect()} == {r.digest for r in second.filter("page_id NOT IN (2, 3) AND html IS NOT NULL").selectExpr("sha2(html, 256) AS digest").collect()}
