"""Course, lecture, snapshot and page views derived from the given tables (Spark side).

``oracle_views`` states the same views in SQL. Minutes are whole numbers, so sums are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coursepulse.sources.schemas import LESSONS

SITE = "https://learn.example.com"
SNAPSHOT_DAY = "2024-01-30"
COMPLETION_DAY = "1998-06-13"
# Observations before this day make the stored lectures, the rest is the batch.
BATCH_DAY = "2024-01-16"
BATCH_TIME = "2024-01-31 00:00:00"
CLASSROOM = "classroom-sidebar-clip__chapter"
# Section tag, heading tag, lesson tag, title tag, time class and closing tags per page source.
OUTLINE_TAGS = {
    "static": ("<section class='curriculum'>", "h2", "<li class='row'>", "a", "time", "</section>"),
    "outline": ("<div class='ac-curriculum'>", "h3", "<li class='lecture'>", "a", "time", "</div>"),
    "purpose": (
        "<section data-purpose='curriculum-section'>", "h2", "<li data-purpose='curriculum-item'>",
        "button", "content-summary", "</section>",
    ),
}


class Views:
    """The views over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            self.tables[name] = self.read(name)
        return self.tables[name]

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def dealt(self, name: str) -> DataFrame:
        """A table whose files are one split each, in as many partitions as the session shuffles into."""
        return self.table(name).repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    def snapshots(self) -> DataFrame:
        """Weekly cumulative minutes per course; weeks without a click are missed weeks."""
        weeks = (
            self.table("events")
            .groupBy(F.col("user_id").alias("course_id"), F.trunc("ts", "week").alias("snapshot_date"))
            .agg(
                F.sum(F.when(F.col("event_type") == "view", F.floor("value")).otherwise(0)).alias("minutes"),
                F.count_if(F.col("event_type") == "click").alias("clicks"),
            )
        )
        # One row per course and week at this point.
        so_far = Window.partitionBy("course_id").orderBy("snapshot_date")
        total = self.table("part").select(
            F.col("p_partkey").alias("course_id"), (700 + 3 * F.col("p_size")).alias("total")
        )
        share = F.floor(F.col("studied") * 10000 / F.col("total") + 0.5)
        return (
            weeks.withColumn("studied", F.sum("minutes").over(so_far))
            .filter("clicks > 0")
            .join(total, "course_id")
            .select(
                "course_id", "snapshot_date",
                F.least(F.lit(100.0), share / 100).alias("progress_rate"),
                F.col("studied").cast("double").alias("study_time"),
                F.col("total").cast("double").alias("total_lecture_time"),
                F.col("snapshot_date").cast("timestamp_ntz").alias("created_at"),
            )
        )

    def courses(self) -> DataFrame:
        latest = self.snapshots().groupBy("course_id").agg(
            F.max_by(F.struct("snapshot_date", "progress_rate", "study_time"), "snapshot_date").alias("s")
        )
        key = F.col("p_partkey")
        return (
            self.table("part").join(latest, key == F.col("course_id"), "left")
            .select(
                key.alias("course_id"),
                _title().alias("course_title"),
                F.coalesce("s.progress_rate", F.lit(0.0)).alias("progress_rate"),
                F.coalesce("s.study_time", F.lit(0.0)).alias("study_time"),
                (700 + 3 * F.col("p_size")).cast("double").alias("total_lecture_time"),
                _url().alias("url"),
                F.lit(None).cast("int").alias("display_order"),
                (key % 5 == 0).alias("is_target_course"),
                F.col("s.snapshot_date").cast("timestamp_ntz").alias("updated_at"),
            )
        )

    def lectures(self) -> DataFrame:
        done = F.col("l_linestatus") == "F"
        at = F.col("l_shipdate") + F.make_dt_interval(
            F.lit(0), (F.col("l_orderkey") % 24).cast("int"), (F.col("l_suppkey") % 60).cast("int")
        )
        return self.table("lineitem").select(
            F.col("l_partkey").alias("course_id"),
            F.col("l_linenumber").alias("section_number"),
            F.concat(F.lit("Part "), F.col("l_linenumber").cast("string")).alias("section_title"),
            F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "R", 2).alias("chapter_number"),
            F.when(F.col("l_returnflag") != "N", F.concat(F.lit("Chapter "), F.col("l_returnflag")))
            .alias("chapter_title"),
            F.col("l_orderkey").alias("lecture_number"),
            F.concat(F.lit("Lecture "), F.col("l_orderkey").cast("string")).alias("lecture_title"),
            F.floor("l_quantity").cast("double").alias("lecture_time"),
            done.alias("is_completed"),
            F.lit(None).cast("int").alias("sort_order"),
            F.when(done, at).alias("completed_at"),
        )

    def observations(self) -> DataFrame:
        """Lecture states as seen over time, numbered by event."""
        k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
        chapter = F.when(k % 3 != 0, k % 3)
        return self.table("events").select(
            F.col("user_id").alias("course_id"),
            (k % 5 + 1).alias("section_number"),
            chapter.alias("chapter_number"),
            (k % 4).alias("lecture_number"),
            F.concat(F.lit("Part "), (k % 5 + 1).cast("string")).alias("section_title"),
            F.when(chapter.isNotNull(), F.concat(F.lit("Chapter "), F.col("event_type"))).alias("chapter_title"),
            F.concat(F.lit("Lecture "), F.col("event_id").cast("string")).alias("lecture_title"),
            F.floor("value").cast("double").alias("lecture_time"),
            F.col("event_type").isin("view", "purchase").alias("is_completed"),
            k.alias("sort_order"),
            F.col("ts").alias("observed_at"),
            F.col("event_id").alias("seq"),
        )

    def lecture_items(self) -> DataFrame:
        """The observations as lecture records with text ids, some of them invalid."""
        broken = F.col("sort_order") == 77
        return self.observations().withColumn(
            "course_id",
            F.concat(F.when(broken, F.lit("x")).otherwise(F.lit("")), F.col("course_id").cast("string")),
        ).withColumn("item_type", F.lit("lecture"))

    def stored_lectures(self) -> DataFrame:
        """Lecture table made from the observations before the batch day."""
        from coursepulse.operators.history import completion_history

        before = self.observations().filter(F.col("observed_at") < F.lit(BATCH_DAY).cast("date"))
        return completion_history(before).select(
            "course_id", "section_number", "section_title", "chapter_number", "chapter_title",
            "lecture_number", "lecture_title", "lecture_time", "is_completed", "sort_order", "completed_at",
        )

    def batch_items(self) -> DataFrame:
        return self.lecture_items().filter(F.col("observed_at") >= F.lit(BATCH_DAY).cast("date"))

    def page_text(self) -> DataFrame:
        """One page per part: url, title, heading, visible text and a duration text."""
        key, size = F.col("p_partkey"), F.col("p_size")

        def text(c):
            return c.cast("string")

        page_title = F.concat(
            F.when(key % 31 == 0, F.lit("인증 ")).otherwise(F.lit("")),
            F.when(key % 3 == 0, F.concat("p_brand", F.lit(" - "), _title(), F.lit(" - end")))
            .when(key % 3 == 1, F.concat(_title(), F.lit(" | "), F.col("p_brand")))
            .otherwise(F.lit("x")),
        )
        study = F.when(
            key % 2 == 0, F.concat(text(key % 50), F.lit(":"), text(size % 60))
        ).otherwise(F.concat(text(key % 7), F.lit(":"), text(size % 60), F.lit(":"), text(key % 60)))
        body = F.when(key % 19 == 0, F.lit("아직 없음")).otherwise(F.concat(
            F.lit("수강률 "), text(size), F.when(key % 2 == 0, F.lit(".5")).otherwise(F.lit("")),
            F.lit("%\n수강시간 "), study,
            F.lit(" 강의시간 "), text(key % 30), F.lit(":"), text(size % 60), F.lit(":"), text(key % 4 * 15),
        ))
        return self.table("part").select(
            key.alias("page_id"),
            F.when(key % 29 == 0, F.lit(SITE + "/account/sign-in")).otherwise(_url()).alias("url"),
            page_title.alias("page_title"),
            F.when(key % 4 == 0, F.lit("")).otherwise(F.concat("p_type", F.lit(" "), _title())).alias("h1"),
            body.alias("body_text"),
            _duration(key, size).alias("duration"),
        )

    def course_items(self) -> DataFrame:
        """Course records of the page texts, numbered by page."""
        from coursepulse.plans.collect import course_records

        return course_records(self.page_text().withColumn("seq", F.col("page_id"))).withColumn(
            "item_type", F.lit("course")
        )

    def curricula(self) -> DataFrame:
        """One nested curriculum per document: lines are sections, sentences lectures.

        In lines of odd length each sentence is a chapter and its clauses are the lectures.
        """
        def lessons(texts):
            # Lengths are counted once a text.
            sized = F.transform(texts, lambda t: F.struct(t.alias("t"), F.length(t).alias("n")))
            return F.transform(sized, lambda x: F.struct(
                x["t"].alias("title"), _duration(x["n"], x["n"] % 50).alias("duration"),
                (x["n"] % 2 == 0).alias("is_completed"),
            ))

        def section(line, index):
            sentences = F.split(line, r"\. ")
            odd = F.length(line) % 2 == 1
            number = (index + 1).cast("int")
            chapters = F.transform(sentences, lambda s, i: F.struct(
                (i + 1).cast("int").alias("chapter_number"),
                F.concat(F.lit("Chapter "), (i + 1).cast("string")).alias("chapter_title"),
                lessons(F.split(s, ", ")).alias("lessons"),
            ))
            return F.struct(
                F.concat(F.lit("Part "), number.cast("string")).alias("section"),
                number.alias("section_number"),
                F.size(F.filter(sentences, lambda s: F.length(s) % 2 == 0)).alias("complete_count"),
                F.size(sentences).alias("total_count"),
                F.when(odd, chapters).alias("chapters"),
                F.when(~odd, lessons(sentences)).alias("lessons"),
            )

        lines = F.split("text", "\n")
        return self.dealt("documents").select(
            F.col("doc_id").alias("course_id"), F.transform(lines, section).alias("sections")
        )

    def classroom_pages(self) -> DataFrame:
        """The curricula written out as classroom pages.

        Every seventh section has an unreadable count. Sections with chapters hold a loose lesson
        and an empty chapter beside them.
        """
        def tag(name, class_name, *inner):
            return F.concat(
                F.lit(f'<{name} class="{CLASSROOM}{class_name}">'), *inner, F.lit(f"</{name}>\n")
            )

        def lesson(x):
            complete = F.when(x["is_completed"], F.lit(f" {CLASSROOM}__clip--complete")).otherwise(F.lit(""))
            return F.concat(
                F.lit(f'<div class="{CLASSROOM}__clip'), complete, F.lit('">'),
                tag("span", "__clip__title", _escape(x["title"])),
                tag("span", "__clip__time", F.coalesce(x["duration"], F.lit(""))),
                F.lit("</div>"),
            )

        def lessons(array):
            return F.array_join(F.transform(array, lesson), "")

        def chapter(x):
            return tag("div", "__part", tag("p", "__part__title", x["chapter_title"]), lessons(x["lessons"]))

        def section(x):
            # A count that is no number, or that fits no column, makes a section unreadable.
            total = (
                F.when(x["section_number"] % 14 == 0, F.lit("99999999999999999999999"))
                .when(x["section_number"] % 7 == 0, F.lit("?"))
                .when(x["section_number"] % 9 == 0, F.lit("99999999999"))
                .otherwise(x["total_count"].cast("string"))
            )
            chapters = F.concat(
                F.array_join(F.transform(x["chapters"], chapter), ""),
                tag("div", "__part", tag("p", "__part__title", F.lit("Empty"))),
                tag("div", "__clip", tag("span", "__clip__title", F.lit("Loose"))),
            )
            return tag(
                "div", "",
                tag("b", "__title__text", x["section"]),
                tag("i", "__title__number__complete", x["complete_count"].cast("string")),
                tag("i", "__title__number__total", total),
                F.coalesce(chapters, lessons(x["lessons"])),
            )

        number = F.col("course_id").cast("string")
        html = F.concat(
            F.lit("<!DOCTYPE html><html><head><title>Classroom - Course number "), number,
            F.lit("</title></head><body><h1>Course number "), number, F.lit("</h1><p>수강률 <b>"),
            (F.col("course_id") % 101).cast("string"), F.lit("</b>%</p><p>수강시간 <b>1:30:45</b></p>"),
            F.array_join(F.transform("sections", section), ""), F.lit("</body></html>"),
        )
        return self.curricula().select(
            F.col("course_id").alias("page_id"),
            F.concat(F.lit(SITE + "/classroom/"), number).alias("url"),
            F.when(F.col("course_id") % 97 != 5, html).alias("html"),  # some pages were never fetched
        )

    def outline_pages(self, profile: str) -> DataFrame:
        """The curricula without chapters written out as static pages of one page source.

        Every fifth section has no title. Pages of a single section are a plain list.
        """
        open_section, heading, open_lesson, name, time, close_section = OUTLINE_TAGS[profile]

        def lesson(x):
            return F.concat(
                F.lit(open_lesson), F.lit(f"<{name}>"), _escape(x["title"]), F.lit(f"</{name.split()[0]}>"),
                F.lit(f'<em class="{time}">'), F.coalesce(x["duration"], F.lit("")), F.lit("</em></li>"),
            )

        def section(x):
            title = F.when(
                x["section_number"] % 5 != 0,
                F.concat(F.lit(f"<{heading}> "), x["section"], F.lit(f"</{heading}>")),
            ).otherwise(F.lit(""))
            return F.concat(
                F.lit(open_section), title,
                F.array_join(F.transform(F.coalesce(x["lessons"], F.array().cast(LESSONS)), lesson), ""),
                F.lit(close_section),
            )

        def plain(x):
            items = F.transform(x["lessons"], lambda y: F.concat(F.lit("<li>"), _escape(y["title"])))
            return F.concat(F.lit('<ul class="curriculum">'), F.array_join(items, ""), F.lit("</ul>"))

        number = F.col("course_id").cast("string")
        sections = F.col("sections")
        listed = F.when(F.size(sections) == 1, F.coalesce(plain(sections[0]), F.lit("")))
        html = F.concat(
            F.lit("<html><head><title>x</title></head><body><h1 class='title'>\n Course "), number,
            F.lit(" </h1>"), F.coalesce(listed, F.array_join(F.transform(sections, section), "")),
            F.lit("</body></html>"),
        )
        return self.curricula().select(
            F.col("course_id").alias("page_id"), F.concat(F.lit(SITE + "/course/"), number).alias("url"),
            html.alias("html"),
        )

    def listings(self) -> DataFrame:
        """Course boxes of every page's navigation links: relative, absolute or by data attribute."""
        hrefs = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))

        def box(href, i):
            key = (F.col("page_id") * 100 + i).cast("string")
            return F.struct(
                F.when(i % 4 == 0, F.concat(F.lit("/classroom"), href))
                .when(i % 4 == 1, F.concat(F.lit(SITE + "/classroom"), href, F.lit("?tab=1")))
                .when(i % 4 == 2, href).alias("href"),
                F.when(i % 3 == 0, F.lit("")).alias("data_course_id"),
                F.when(F.col("page_id") % 4 != 0, key).alias("data_id"),
                F.lit(None).cast("string").alias("data_key"),
            )

        return self.dealt("pages").select("page_id", F.transform(hrefs, box).alias("boxes"))

    def listing_pages(self) -> DataFrame:
        """The course boxes written out as listing pages."""
        def attribute(name, value):
            return F.coalesce(F.concat(F.lit(f' {name}="'), value, F.lit('"')), F.lit(""))

        def box(x):
            return F.concat(
                F.lit('<div class="vn-me-courses__box"><a href="/help">?</a>'),
                F.coalesce(F.concat(F.lit('<a href="'), x["href"], F.lit('">go</a>')), F.lit("")),
                F.lit("<button data-e2e='classroom-enter-button'"),
                attribute("data-course-id", x["data_course_id"]), F.lit("></button>"),
                F.lit("<button>"), F.lit("</button></div>"),
            )

        def marked(x):
            return F.replace(box(x), F.lit("<button data-e2e='classroom-enter-button'"), F.concat(
                F.lit("<button data-e2e='classroom-enter-button'"), attribute("data-id", x["data_id"])))

        html = F.array_join(F.transform("boxes", marked), "\n")
        return self.listings().select("page_id", F.lit(None).cast("string").alias("url"), html.alias("html"))


def _escape(text):
    """Text as HTML content."""
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _title():
    return F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string"))


def _url():
    key = F.col("p_partkey")
    tail = F.when(key % 13 == 0, F.lit("?tab=1")).when(key % 11 == 0, F.lit("/")).otherwise(F.lit(""))
    return F.when(key % 17 != 0, F.concat(F.lit(SITE + "/classroom/"), key.cast("string"), tail))


def _duration(a, b):
    """A duration text in one of the shapes the parsers know, picked by ``a``."""
    a_text, b_text = a.cast("string"), b.cast("string")
    kind = a % 12
    # Nothing, a no-break space or a wide space before the unit.
    space = F.element_at(F.array(F.lit(""), F.lit("\u00a0"), F.lit("\u3000")), (b % 3 + 1).cast("int"))
    return (
        F.when(kind == 0, F.concat(b_text, F.lit("분")))
        .when(kind == 1, F.concat(b_text, space, F.lit("시간")))
        .when(kind == 2, F.concat(b_text, F.lit("시간 "), (a % 60).cast("string"), space, F.lit("분")))
        .when(kind == 3, F.concat((a % 90).cast("string"), F.lit(":"), b_text))
        .when(kind == 4, F.concat(b_text, F.lit(":"), (a % 60).cast("string"), F.lit(":"), (a % 59).cast("string")))
        .when(kind == 5, a_text)
        .when(kind == 6, F.lit("abc"))
        .when(kind == 7, F.lit("a:b"))
        .when(kind == 8, F.concat(F.lit("1:2:3:"), b_text))
        .when(kind == 9, F.lit(""))
        .when(kind == 10, F.concat(b_text, F.lit("시간 뒤")))
        .otherwise(F.lit(None).cast("string"))
    )
