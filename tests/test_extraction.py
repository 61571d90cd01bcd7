import pytest

from coursepulse.operators import curriculum, extraction, markup
from coursepulse.plans import collect

P = "classroom-sidebar-clip__chapter"


def clip(title, time="", done=False):
    mark = f" {P}__clip--complete" if done else ""
    return (f'<li class="{P}__clip{mark}"><span class="{P}__clip__title"> {title}\n </span>'
            f'<span class="{P}__clip__time">{time}</span></li>')


def section(body, title="Part", complete="1", total="2"):
    return (f'<div class="box {P}"><b class="{P}__title__text">{title}</b>'
            f'<i class="{P}__title__number__complete">{complete}</i>/<i class="{P}__title__number__total">{total}</i>{body}</div>')


def chapter(title, *clips):
    return f'<div class="{P}__part"><p class="{P}__part__title">{title}</p>{"".join(clips)}</div>'


def run(spark, html, profile):
    pages = spark.createDataFrame([(1, "https://x/classroom/1", html)], "page_id BIGINT, url STRING, html STRING")
    return extraction.extract_pages(pages, profile).first()


CLASSROOM = "<html><head><title>S - A classroom title</title></head><body><h1>A <b>head</b>ing\n line</h1>" + "".join([
    section(chapter("One", clip("a", "1:00", True), clip("b")) + chapter("None") + chapter("Two", clip("c", "2:00")) + clip("loose")),
    section("", "Empty"),
    section(clip("n"), "Not a number", total="x"),
    section(clip("d &amp; &lt;e&gt;", "3:00", True), "Plain", "1", "1"),
    section(f'<p class="{P}__part__title">astray</p>' + clip("lost"), "Astray"),
]) + "</body></html>"


def test_classroom(spark):
    row = run(spark, CLASSROOM, "classroom")
    assert (row.page_title, row.h1) == ("S - A classroom title", "A heading line")
    first, plain = row.sections
    assert (first.section_number, plain.section_number) == (1, 4)
    assert [(c.chapter_number, c.chapter_title, [(x.title, x.duration, x.is_completed) for x in c.lessons])
            for c in first.chapters] == [(1, "One", [("a", "1:00", True), ("b", "", False)]), (3, "Two", [("c", "2:00", False)])]
    assert first.lessons is None and plain.chapters is None
    assert [(x.title, x.is_completed) for x in plain.lessons] == [("d & <e>", True)]
    assert (plain.complete_count, plain.total_count) == (1, 1)


def test_classroom_flat_takes_every_clip(spark):
    row = run(spark, CLASSROOM, "classroom_flat")
    assert [[x.title for x in s.lessons] for s in row.sections] == [["a", "b", "c", "loose"], ["d & <e>"], ["lost"]]


def test_static(spark):
    row = run(spark, """
        <section class="curriculum"><h2> One </h2><ul>
          <li><a>first<b>!</b></a><span class="time"> 1:00 </span>
          <li><span>second</span></li><li class="lesson-item">no title tag</li></ul></section>
        <div class="course-section"><p>untitled</p></div>
        <div class="curriculum-section"><div class="section-title">Nothing in it</div></div>""", "static")
    assert [(s.section_number, s.section, [(x.title, x.duration) for x in s.lessons]) for s in row.sections] == [
        (1, "One", [("first", "1:00"), ("second", None)]), (2, "Nothing in it", [])]


def test_static_lists_only_without_sections(spark):
    row = run(spark, """<div class="curriculum"><ul><li>a</li><li> <b>late text</b></li></ul><ol><li> </li></ol></div>
        <ul class="curriculum"><li>b<ul><li>c</li></ul></li></ul>""", "static")
    assert [(s.section, [x.title for x in s.lessons]) for s in row.sections] == [
        ("Section 1", ["a"]), ("Section 3", ["b", "c"])]


@pytest.mark.parametrize("profile, html", [
    ("outline", '<h1 class="title"> Head </h1><div class="ac-curriculum"><h3>One</h3>'
                '<div class="ac-curriculum-item"><a>x</a><i class="duration">2:00</i></div><li>no</li></div>'),
    ("purpose", '<h1 data-purpose="lead-title"> Head </h1><section data-purpose="curriculum-section"><h2>One</h2>'
                '<li data-purpose="curriculum-item"><button>x</button><i class="content-summary">2:00</i></li><li>no</li></section>'),
])
def test_outline_records(spark, profile, html):
    pages = spark.createDataFrame([(1, "u", html), (2, "u", "<p>none</p>")], "page_id BIGINT, url STRING, html STRING")
    rows = extraction.outline_records(pages, profile).collect()
    assert [(r.page_id, r.title, r.total_sections) for r in rows] == [(1, "Head", 1)]
    assert [(x.title, x.duration) for x in rows[0].curriculum[0].lessons] == [("x", "2:00")]


def test_listing_boxes(spark):
    html = """
        <div class="vn-me-courses__box"><a href="/help">h</a><a href="/classroom/1">a</a><a href="/classroom/2">b</a></div>
        <div class="vn-me-courses__box"><button>x</button><button data-e2e="classroom-enter-button" data-id="3"></button></div>
        <div class="vn-me-courses__box"><button data-key="4" data-course-id="">x</button><button data-e2e="classroom-enter-button"></button></div>
        <div class="vn-me-courses__box"><button>x</button></div><a href="/classroom/9">outside</a>"""
    pages = spark.createDataFrame([(1, None, html)], "page_id BIGINT, url STRING, html STRING")
    boxes = extraction.extract_listings(pages)
    assert [tuple(b) for b in boxes.first().boxes] == [
        ("/classroom/1", None, None, None), (None, None, "3", None), (None, "", None, "4"), (None, None, None, None)]
    links = curriculum.resolve_course_links(boxes, "https://s").collect()
    assert [(r.position, r.url) for r in links] == [
        (1, "https://s/classroom/1"), (2, "https://s/classroom/3"), (3, "https://s/classroom/4")]


def test_unknown_profile(spark):
    with pytest.raises(ValueError, match="unknown profile"):
        extraction.extract_pages(spark.range(1), "nope")


def test_a_bad_page_does_not_end_the_job(spark):
    part = "classroom-sidebar-clip__chapter"
    def section(count):
        return (f'<div class="{part}"><i class="{part}__title__number__total">{count}</i>'
                f'<div class="{part}__clip"><span class="{part}__clip__title">x</span></div></div>')
    pages = spark.createDataFrame([(1, "u", section("99999999999") + section("9" * 30)), (2, "u", None), (2**63 - 1, "u", section("2"))],
                                  "page_id long, url string, html string")
    rows = {r.page_id: r for r in extraction.extract_pages(pages, fields=("sections", "rejected")).collect()}
    assert [s.total_count for s in rows[1].sections] == [99999999999] and rows[1].rejected is None
    assert rows[2].rejected == "no markup" and rows[2].sections is None
    assert [s.total_count for s in rows[2**63 - 1].sections] == [2]


def test_only_asked_fields_are_sent(spark):
    pages = spark.createDataFrame([(1, "u", "<title>t</title>")], "page_id long, url string, html string")
    assert extraction.extract_pages(pages, fields=("page_title",)).columns == ["page_id", "page_title"]


def test_page_items(spark):
    pages = spark.createDataFrame(
        [(1, "https://x/classroom/1", CLASSROOM), (2, "https://x/sign-in", CLASSROOM), (3, "https://x/classroom/3", "<title>t</title>")],
        "page_id BIGINT, url STRING, html STRING")
    rows = collect.page_items(pages).orderBy("seq").collect()
    assert [(r.item_type, r.course_id, r.lecture_title, r.chapter_number, r.lecture_number, r.lecture_time, r.sort_order) for r in rows] == [
        ("course", "1", None, None, None, None, None),
        ("lecture", "1", "a", 1, 1, 1.0, 1), ("lecture", "1", "b", 1, 2, 0.0, 2), ("lecture", "1", "c", 3, 1, 2.0, 3),
        ("lecture", "1", "d & <e>", None, 1, 3.0, 4),
        ("course", "3", None, None, None, None, None)]
    assert rows[0].course_title == "A classroom title" and rows[-1].course_title == "Course 3"


@pytest.mark.parametrize("html, text", [
    ("", ""), ("a < b &amp; c", "a < b & c"), ("<p>a</p><p>b", "a b"), ("x<script>if (a<b) {'</p>'}</script>y", "xy"),
    ("<!-- <p>no</p> -->yes", "yes"), ("<!-- open", ""), ("<p title='it\"s'>q</p>", "q"), ("<p title='open>q</p>", "<p title='open>q"),
    ("a<br>b<BR/>c", "a b c"), ("<style>p{}</style><b>x</b> \t\n y", "x y"), ("</p></div>z", "z"), ("&#x41;&nbsp;", "A"),
])
def test_visible_text(html, text):
    page = markup.Page(html)
    assert page.text(page.root) == text


def test_deep_nesting_does_not_recurse():
    page = markup.Page("<b>" * 20000 + "x")
    assert page.text(page.root) == "x" and len(page.elements) == 20001


def test_a_task_holds_the_results_of_few_pages(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(extraction, "HELD_CHARS", 100)
    batch = pa.RecordBatch.from_pydict({"page_id": list(range(50)), "url": ["u"] * 50, "html": ["<p>" * 10] * 49 + [None]})
    schema = pa.schema([("page_id", pa.int64())])
    found = list(extraction._read_rows([batch], lambda page_id, url, html: {"page_id": page_id}, schema))
    assert max(map(len, found)) <= 4 and [x for part in found for x in part["page_id"].to_pylist()] == list(range(50))


def test_tags_are_taken_apart_once(monkeypatch):
    seen, own = [], markup._attributes
    monkeypatch.setattr(markup, "_attributes", lambda text: seen.append(text) or own(text))
    markup._known.clear()
    page = markup.Page('<i class="a b">x</i>' * 100)
    assert seen == [' class="a b"'] and len(page.find(page.root, markup.Selector(".b"))) == 100
    monkeypatch.setattr(markup, "KNOWN_TAGS", 3)
    assert len(markup.Page("".join(f"<a href='{i}'>" for i in range(9))).elements) == 10 and len(markup._known) <= 3


@pytest.mark.parametrize("html, tags, text", [
    ("<br>x</br>y", ["br"], "xy"), ("<p>a<p>b</p>c</p>", ["p", "p"], "a b c"), ("<title>t</title>x", ["title"], "x"),
    ("<I>a</i>b</I>", ["i"], "ab"), ("</b>x</b>", [], "x"), ("<b>x</b>y</b>z", ["b"], "xyz"), ("<li>a</li><li>b<li>c</li>", ["li"] * 3, "a b c"),
])
def test_elements_of_one_text(html, tags, text):
    page = markup.Page(html)
    assert [e.tag for e in page.elements[1:]] == tags and page.text(page.root) == text


def test_rejected_pages_are_all_read_and_alone_sent(spark, monkeypatch):
    class Broken(markup.Page):
        def text(self, element):
            if element.tag == "body":
                raise ValueError("no body text")
            return super().text(element)

    monkeypatch.setattr(markup, "Page", Broken)
    pages = spark.createDataFrame([(1, "u", CLASSROOM), (2, "u", None), (3, "u", "<p>x")], "page_id long, url string, html string")
    rows = extraction.rejected_pages(pages)
    assert rows.columns == ["page_id", "url", "rejected"]
    assert sorted((r.page_id, r.rejected) for r in rows.collect()) == [(1, "ValueError: no body text"), (2, "no markup")]
