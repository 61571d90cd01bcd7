"""SQL that answers the registered queries independently, for DuckDB on the same tables.

The views restate ``views`` in SQL. The queries use other means than the engine where there are any:
self-joins instead of frames, row-by-row transitions instead of the closed form, expected rows
instead of parsed markup.
"""

from __future__ import annotations

import re

SITE = "https://learn.example.com"


def hm(x: str) -> str:
    return (f"cast(cast(floor(({x}) / 60) as bigint) as varchar) || '시간 ' || "
            f"cast(cast(floor(({x}) % 60) as bigint) as varchar) || '분'")


def ratio(numerator: str, denominator: str, digits: int = 2) -> str:
    """numerator / denominator rounded half up, for non-negative whole numbers."""
    scale = 10 ** digits
    return f"floor(({numerator}) * {scale} / ({denominator}) + 0.5) / {scale}"


def duration(a: str, b: str) -> str:
    space = f"CASE ({b}) % 3 WHEN 1 THEN chr(160) WHEN 2 THEN chr(12288) ELSE '' END"
    return f"""CASE ({a}) % 12
        WHEN 0 THEN cast({b} as varchar) || '분'
        WHEN 1 THEN cast({b} as varchar) || {space} || '시간'
        WHEN 2 THEN cast({b} as varchar) || '시간 ' || cast(({a}) % 60 as varchar) || {space} || '분'
        WHEN 3 THEN cast(({a}) % 90 as varchar) || ':' || cast({b} as varchar)
        WHEN 4 THEN cast({b} as varchar) || ':' || cast(({a}) % 60 as varchar) || ':' || cast(({a}) % 59 as varchar)
        WHEN 5 THEN cast({a} as varchar)
        WHEN 6 THEN 'abc'
        WHEN 7 THEN 'a:b'
        WHEN 8 THEN '1:2:3:' || cast({b} as varchar)
        WHEN 9 THEN ''
        WHEN 10 THEN cast({b} as varchar) || '시간 뒤'
        END"""


def _part(s: str, i: int) -> str:
    return f"try_cast(trim(string_split(trim({s}), ':')[{i}]) as bigint)"


def _colons(s: str) -> str:
    return f"CASE WHEN contains({s}, ':') THEN len(string_split({s}, ':')) ELSE 1 END"


# White space, no-break and wide spaces too.
BLANKS = r"[\s\x{A0}\x{3000}]*"
BLANK = "' ' || chr(160) || chr(12288)"


def _worded(s: str) -> str:
    return (f"coalesce(try_cast(regexp_extract({s}, '([0-9]+){BLANKS}시간', 1) as bigint) * 60, 0)"
            f" + coalesce(try_cast(regexp_extract({s}, '([0-9]+){BLANKS}분', 1) as bigint), 0)")


def daily(s: str) -> str:
    a, b, c = (_part(s, i) for i in (1, 2, 3))
    return f"""coalesce(round(CASE {_colons(s)}
        WHEN 3 THEN {a} * 60 + {b} + round(cast({c} as double) / 60, 2)
        WHEN 2 THEN {a} + round(cast({b} as double) / 60, 2)
        ELSE cast({_worded(s)} as double) END, 2), 0.0)"""


def full(s: str) -> str:
    a, b, c = (_part(s, i) for i in (1, 2, 3))
    return f"""coalesce(CASE {_colons(s)}
        WHEN 3 THEN {a} * 60 + {b} + cast({c} as double) / 60
        WHEN 2 THEN CASE WHEN {a} > 60 THEN {a} + cast({b} as double) / 60 ELSE cast({a} * 60 + {b} as double) END
        ELSE cast({_worded(s)} as double) END, 0.0)"""


def strict(s: str) -> str:
    a, b, c = (_part(s, i) for i in (1, 2, 3))
    after = f"string_split({s}, '시간')[2]"
    value = f"""CASE
        WHEN {_colons(s)} = 3 THEN {a} * 60 + {b} + round(cast({c} as double) / 60, 2)
        WHEN {_colons(s)} = 2 THEN {a} + round(cast({b} as double) / 60, 2)
        WHEN contains({s}, ':') THEN 0.0
        WHEN contains({s}, '시간') THEN
            try_cast(trim(string_split({s}, '시간')[1], {BLANK}) as bigint) * 60.0
            + CASE WHEN contains({after}, '분') THEN try_cast(trim(replace({after}, '분', ''), {BLANK}) as bigint) ELSE 0 END
        WHEN contains({s}, '분') THEN cast(try_cast(trim(replace({s}, '분', ''), {BLANK}) as bigint) as double)
        WHEN regexp_full_match({s}, '[0-9]+') THEN cast({s} as double) END"""
    return f"(SELECT CASE WHEN v > 0 THEN cast(v as double) END FROM (SELECT {value} AS v))"


CLASSROOM_ID = "string_split(string_split({u}, '/classroom/')[-1], '?')[1]"
PATH_ID = ("CASE WHEN regexp_full_match(string_split(rtrim({u}, '/'), '/')[-1], '[0-9]+') "
           "THEN try_cast(string_split(rtrim({u}, '/'), '/')[-1] as bigint) END")
URL = ("CASE WHEN p_partkey % 17 <> 0 THEN '" + SITE + "/classroom/' || p_partkey || "
       "CASE WHEN p_partkey % 13 = 0 THEN '?tab=1' WHEN p_partkey % 11 = 0 THEN '/' ELSE '' END END")
TITLE = "p_name || ' #' || p_partkey"
KEY = "course_id, section_number, chapter_number, lecture_number"


def same_key(a: str, b: str) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in KEY.split(", "))


VIEWS = {
    "weeks": """
        SELECT user_id AS course_id, cast(date_trunc('week', ts) as date) AS snapshot_date,
            cast(sum(CASE WHEN event_type = 'view' THEN floor(value) ELSE 0 END) as bigint) AS minutes,
            count(*) FILTER (event_type = 'click') AS clicks
        FROM events GROUP BY ALL""",
    "snapshots": """
        SELECT w.course_id, w.snapshot_date,
            least(100.0::double, floor(w.studied * 10000 / (700 + 3 * p_size) + 0.5) / 100) AS progress_rate,
            cast(w.studied as double) AS study_time,
            cast(700 + 3 * p_size as double) AS total_lecture_time,
            cast(w.snapshot_date as timestamp) AS created_at
        FROM (SELECT a.course_id, a.snapshot_date, a.clicks, cast(sum(b.minutes) as bigint) AS studied
              FROM weeks a JOIN weeks b ON a.course_id = b.course_id AND b.snapshot_date <= a.snapshot_date
              GROUP BY ALL) w
        JOIN part ON p_partkey = w.course_id
        WHERE w.clicks > 0""",
    "courses": f"""
        SELECT p_partkey AS course_id, {TITLE} AS course_title,
            coalesce(s.progress_rate, 0.0::double) AS progress_rate,
            coalesce(s.study_time, 0.0::double) AS study_time,
            cast(700 + 3 * p_size as double) AS total_lecture_time,
            {URL} AS url, cast(NULL as integer) AS display_order,
            p_partkey % 5 = 0 AS is_target_course,
            cast(s.snapshot_date as timestamp) AS updated_at
        FROM part LEFT JOIN (SELECT * FROM snapshots QUALIFY row_number() OVER
            (PARTITION BY course_id ORDER BY snapshot_date DESC) = 1) s ON s.course_id = p_partkey""",
    "lectures": """
        SELECT l_partkey AS course_id, l_linenumber AS section_number, 'Part ' || l_linenumber AS section_title,
            CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 END AS chapter_number,
            CASE WHEN l_returnflag <> 'N' THEN 'Chapter ' || l_returnflag END AS chapter_title,
            l_orderkey AS lecture_number, 'Lecture ' || l_orderkey AS lecture_title,
            floor(l_quantity) AS lecture_time, l_linestatus = 'F' AS is_completed,
            cast(NULL as integer) AS sort_order,
            CASE WHEN l_linestatus = 'F' THEN l_shipdate + to_hours(cast(l_orderkey % 24 as integer))
                + to_minutes(cast(l_suppkey % 60 as integer)) END AS completed_at
        FROM lineitem""",
    "observations": """
        SELECT user_id AS course_id, k % 5 + 1 AS section_number,
            CASE WHEN k % 3 <> 0 THEN k % 3 END AS chapter_number, k % 4 AS lecture_number,
            'Part ' || (k % 5 + 1) AS section_title,
            CASE WHEN k % 3 <> 0 THEN 'Chapter ' || event_type END AS chapter_title,
            'Lecture ' || event_id AS lecture_title, floor(value) AS lecture_time,
            event_type IN ('view', 'purchase') AS is_completed, k AS sort_order, ts AS observed_at, event_id AS seq
        FROM (SELECT *, cast(regexp_extract(props, '([0-9]+)', 1) as integer) AS k FROM events)""",
    "stored_lectures": f"""
        SELECT course_id, section_number, last.section_title, chapter_number, last.chapter_title, lecture_number,
            last.lecture_title, last.lecture_time, last.is_completed, last.sort_order,
            CASE WHEN last.is_completed THEN turned_done END AS completed_at
        FROM (SELECT {KEY}, arg_max(row, seq) AS last, max(CASE WHEN turned THEN observed_at END) AS turned_done
              FROM (SELECT *, o AS row,
                        is_completed AND NOT coalesce(lag(is_completed) OVER
                            (PARTITION BY {KEY} ORDER BY seq), false) AS turned
                    FROM observations o WHERE observed_at < DATE '2024-01-16')
              GROUP BY ALL)""",
    "page_text": f"""
        SELECT p_partkey AS page_id,
            CASE WHEN p_partkey % 29 = 0 THEN '{SITE}/account/sign-in' ELSE {URL} END AS url,
            CASE WHEN p_partkey % 31 = 0 THEN '인증 ' ELSE '' END || CASE p_partkey % 3
                WHEN 0 THEN p_brand || ' - ' || {TITLE} || ' - end'
                WHEN 1 THEN {TITLE} || ' | ' || p_brand ELSE 'x' END AS page_title,
            CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_type || ' ' || {TITLE} END AS h1,
            CASE WHEN p_partkey % 19 = 0 THEN '아직 없음' ELSE
                '수강률 ' || p_size || CASE WHEN p_partkey % 2 = 0 THEN '.5' ELSE '' END || '%' || chr(10)
                || '수강시간 ' || CASE WHEN p_partkey % 2 = 0 THEN (p_partkey % 50) || ':' || (p_size % 60)
                    ELSE (p_partkey % 7) || ':' || (p_size % 60) || ':' || (p_partkey % 60) END
                || ' 강의시간 ' || (p_partkey % 30) || ':' || (p_size % 60) || ':' || (p_partkey % 4 * 15) END AS body_text,
            {duration('p_partkey', 'p_size')} AS duration
        FROM part""",
    "titles": f"""
        SELECT page_id, page_title, h1, {CLASSROOM_ID.format(u='url')} AS cid, length(h1) AS h1_length,
            trim(CASE WHEN contains(page_title, ' - ')
                    THEN substr(page_title, instr(page_title, ' - ') + 3)
                WHEN contains(page_title, '|') THEN string_split(page_title, '|')[1] END) AS t
        FROM page_text""",
    "titled": """
        SELECT page_id, CASE WHEN coalesce(length(t2), 0) < 5 THEN trim('Course ' || cid) ELSE t2 END AS course_title
        FROM (SELECT *, CASE WHEN coalesce(length(t), 0) < 10 AND h1_length > 10 THEN trim(h1) ELSE t END AS t2
              FROM titles)""",
    "metrics": """
        SELECT page_id,
            coalesce(try_cast(nullif(regexp_extract(body_text, '수강률\\s*([0-9]+(?:\\.[0-9]+)?)\\s*%', 1), '') as double), 0) AS progress_rate,
            CASE WHEN s3 IS NOT NULL THEN s1 * 60 + s2 + round(s3 / 60, 2)
                 WHEN s1 IS NOT NULL THEN s1 + round(s2 / 60, 2) ELSE 0 END AS study_time,
            coalesce(t1 * 60 + t2 + t3 / 60, 0) AS total_lecture_time
        FROM (SELECT page_id, body_text,
            try_cast(nullif(regexp_extract(body_text, '수강시간\\s*([0-9]+):([0-9]+)(?::([0-9]+))?', 1), '') as double) AS s1,
            try_cast(nullif(regexp_extract(body_text, '수강시간\\s*([0-9]+):([0-9]+)(?::([0-9]+))?', 2), '') as double) AS s2,
            try_cast(nullif(regexp_extract(body_text, '수강시간\\s*([0-9]+):([0-9]+)(?::([0-9]+))?', 3), '') as double) AS s3,
            try_cast(nullif(regexp_extract(body_text, '강의시간\\s*([0-9]+):([0-9]+):([0-9]+)', 1), '') as double) AS t1,
            try_cast(nullif(regexp_extract(body_text, '강의시간\\s*([0-9]+):([0-9]+):([0-9]+)', 2), '') as double) AS t2,
            try_cast(nullif(regexp_extract(body_text, '강의시간\\s*([0-9]+):([0-9]+):([0-9]+)', 3), '') as double) AS t3
        FROM page_text)""",
    "course_items": f"""
        SELECT page_id, {CLASSROOM_ID.format(u='url')} AS text_id, {PATH_ID.format(u='url')} AS course_id,
            course_title, progress_rate, study_time, total_lecture_time, url
        FROM page_text JOIN titled USING (page_id) JOIN metrics USING (page_id)
        WHERE NOT contains(page_title, '인증') AND NOT contains(url, 'sign-in')""",
    "lines": """
        SELECT doc_id AS course_id, unnest(string_split(text, chr(10))) AS line,
            cast(generate_subscripts(string_split(text, chr(10)), 1) as integer) AS section_number
        FROM documents""",
    "sentences": """
        SELECT course_id, section_number, length(line) % 2 = 1 AS chaptered,
            unnest(string_split(line, '. ')) AS sentence,
            cast(generate_subscripts(string_split(line, '. '), 1) as integer) AS n
        FROM lines""",
    "lessons": f"""
        SELECT *, {duration('length(title)', '(length(title) % 50)')} AS duration, length(title) % 2 = 0 AS is_completed
        FROM (SELECT course_id, section_number, n AS chapter_number, unnest(string_split(sentence, ', ')) AS title,
                  cast(generate_subscripts(string_split(sentence, ', '), 1) as integer) AS lecture_number
              FROM sentences WHERE chaptered
              UNION ALL
              SELECT course_id, section_number, NULL, sentence, n FROM sentences WHERE NOT chaptered)""",
    "boxes": f"""
        SELECT page_id, i, CASE i % 4 WHEN 0 THEN '/classroom' || href WHEN 1 THEN '{SITE}/classroom' || href || '?tab=1'
                WHEN 2 THEN href END AS href,
            CASE WHEN page_id % 4 <> 0 THEN cast(page_id * 100 + i as varchar) END AS data_id
        FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href,
                  generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) - 1 AS i
              FROM pages)""",
    "links": f"""
        SELECT page_id, cast(row_number() OVER (PARTITION BY page_id ORDER BY i) as integer) AS position, url
        FROM (SELECT page_id, i, CASE WHEN contains(href, '/classroom/') AND starts_with(href, '/') THEN '{SITE}' || href
                  WHEN contains(href, '/classroom/') THEN href
                  ELSE '{SITE}/classroom/' || data_id END AS url FROM boxes)
        WHERE url IS NOT NULL""",
}


# White space as a browser shows it.
def shown(text: str) -> str:
    return f"trim(regexp_replace({text}, '[ \\t\\r\\n\\f]+', ' ', 'g'))"


VIEWS["classroom_lessons"] = f"""
    SELECT course_id AS page_id, section_number, chapter_number, lecture_number, {shown('title')} AS lecture_title,
        coalesce(duration, '') AS duration, is_completed
    FROM lessons WHERE section_number % 7 <> 0 AND course_id % 97 <> 5"""
VIEWS["flat_lessons"] = """
    SELECT page_id, section_number, coalesce(chapter_number, 0) AS c, lecture_number AS l, lecture_title, duration, is_completed
    FROM classroom_lessons
    UNION ALL
    SELECT DISTINCT page_id, section_number, 1000000000, 1, 'Loose', '', false
    FROM classroom_lessons WHERE chapter_number IS NOT NULL"""
VIEWS["counts"] = """
    SELECT course_id AS page_id, section_number, length(line) % 2 = 1 AS chaptered,
        len(list_filter(string_split(line, '. '), lambda x: length(x) % 2 = 0)) AS complete_count,
        len(string_split(line, '. ')) AS total_count
    FROM lines"""
# Lessons as a static page shows them: an empty title falls through to the next text for one source.
VIEWS["outline_sections"] = """
    SELECT course_id, section_number, list_sum(cast([1] as bigint[])) AS one,
        list(struct_pack(n := lecture_number, t := title, d := duration) ORDER BY lecture_number) FILTER (chapter_number IS NULL) AS found
    FROM lessons GROUP BY ALL"""
VIEWS["single"] = "SELECT course_id FROM lines GROUP BY ALL HAVING count(*) = 1"


def query(body: str) -> str:
    """The query with the views it needs in front, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, sql in VIEWS.items():
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                visit(sql)

    visit(body)
    ctes = ", ".join(f"{name} AS ({sql})" for name, sql in VIEWS.items() if name in needed)
    return f"WITH {ctes} {body}" if ctes else body


SEEN = "(SELECT * FROM snapshots WHERE snapshot_date <= DATE '2024-01-30')"
DELTA = f"""(SELECT c.*, c.study_time - coalesce(p.study_time, 0) AS weekly_study,
        c.progress_rate - coalesce(p.progress_rate, 0) AS progress_delta
    FROM {SEEN} c LEFT JOIN snapshots p ON p.course_id = c.course_id AND p.snapshot_date = c.snapshot_date - 7)"""
NEWEST = "(SELECT max(snapshot_date) FROM snapshots WHERE snapshot_date <= DATE '2024-01-30')"
STATS = ("count(*) AS lecture_count, sum(lecture_time) AS study_minutes, "
         + ratio("sum(lecture_time)", "60") + " AS study_hours")
ON_DAY = "cast(completed_at as date) = DATE '1998-06-13'"
WITHIN = "completed_at >= DATE '1998-06-13' - {n} AND completed_at < DATE '1998-06-14'"
RECENT = "course_title, section_title, lecture_title, cast(completed_at as date) AS completed_date, lecture_time"
ORDER = ("completed_at DESC, section_number NULLS FIRST, chapter_number NULLS FIRST, lecture_number NULLS FIRST, "
         "lecture_title, lecture_time")
AUDIT = """(SELECT c.course_id, c.url, c.course_title, c.total_lecture_time AS expected_time,
        coalesce(sum(l.lecture_time), 0) AS actual_time,
        c.total_lecture_time - coalesce(sum(l.lecture_time), 0) AS diff
    FROM courses c LEFT JOIN lectures l ON l.course_id = c.course_id
    WHERE c.url IS NOT NULL AND c.total_lecture_time > 0
    GROUP BY c.course_id, c.course_title, c.total_lecture_time, c.url
    HAVING abs(c.total_lecture_time - coalesce(sum(l.lecture_time), 0)) > c.total_lecture_time * 0.1::double)"""
LECTURE_COLUMNS = ("course_id, section_number, section_title, chapter_number, chapter_title, lecture_number, "
                   "lecture_title, lecture_time, is_completed, sort_order, completed_at")
COURSE_VALUES = "course_title, progress_rate, study_time, total_lecture_time, url"
ITEMS = "(SELECT * FROM course_items WHERE course_id > 0)"


def folded(stored: str | None, items: str) -> str:
    """Lecture table after a batch, from row-by-row transitions with the stored state as first row."""
    attributes = "section_title, chapter_title, lecture_title, lecture_time, is_completed, sort_order"
    rows = f"SELECT {KEY}, seq, {attributes}, cast(NULL as timestamp) AS kept FROM {items}"
    if stored:
        rows += f" UNION ALL SELECT {KEY}, -1, {attributes}, completed_at FROM {stored}"
    return f"""
        SELECT course_id, section_number, last.section_title, chapter_number, last.chapter_title, lecture_number,
            last.lecture_title, last.lecture_time, last.is_completed, last.sort_order,
            CASE turn WHEN 1 THEN TIMESTAMP '2024-01-31 00:00:00' WHEN 2 THEN NULL ELSE kept END AS completed_at
        FROM (SELECT {KEY}, arg_max(row, seq) AS last, max(kept) AS kept,
                  arg_max(turn, seq) FILTER (turn IS NOT NULL) AS turn
              FROM (SELECT *, r AS row, CASE
                        WHEN seq < 0 THEN NULL
                        WHEN is_completed AND NOT coalesce(lag(is_completed) OVER w, false) THEN 1
                        WHEN NOT is_completed AND lag(is_completed) OVER w THEN 2 END AS turn
                    FROM ({rows}) r WINDOW w AS (PARTITION BY {KEY} ORDER BY seq))
              GROUP BY ALL)"""


VALID = "(SELECT * FROM observations WHERE sort_order <> 77)"
BATCH = "(SELECT * FROM observations WHERE sort_order <> 77 AND observed_at >= DATE '2024-01-16')"

QUERIES = {
    "weekly_delta": f"SELECT course_id, snapshot_date, progress_rate, study_time, total_lecture_time, created_at, weekly_study, progress_delta FROM {DELTA}",
    "current_week_status": f"""
        SELECT c.course_title, s.progress_rate, s.study_time, {hm('s.study_time')} AS study_hm, s.snapshot_date
        FROM snapshots s JOIN courses c ON s.course_id = c.course_id WHERE s.snapshot_date = {NEWEST}""",
    "week_over_week": f"""
        SELECT c.course_title, weekly_study AS weekly_minutes, {hm('weekly_study')} AS weekly_hm, progress_delta,
            d.progress_rate, d.total_lecture_time - d.study_time AS remaining
        FROM {DELTA} d JOIN courses c ON d.course_id = c.course_id
        WHERE d.snapshot_date = {NEWEST} AND weekly_study > 0""",
    "trend_4w": f"""
        SELECT snapshot_date, count(DISTINCT course_id) AS course_count, sum(study_time) AS total_study,
            cast(cast(floor(sum(study_time) / 1440) as bigint) as varchar) || '일 ' ||
            cast(cast(floor((sum(study_time) % 1440) / 60) as bigint) as varchar) || '시간' AS total_dh,
            floor(cast(sum(cast(round(progress_rate * 100) as bigint)) as double) / count(*) + 0.5) / 100 AS avg_progress
        FROM {SEEN} WHERE snapshot_date >= DATE '2024-01-30' - 28 GROUP BY snapshot_date""",
    "weekly_volume_4w": f"""
        SELECT snapshot_date, count(*) FILTER (weekly_study > 0) AS studied_courses,
            sum(weekly_study) AS weekly_minutes, {hm('sum(weekly_study)')} AS weekly_hm,
            {ratio('sum(weekly_study) FILTER (weekly_study > 0)', 'count(*) FILTER (weekly_study > 0)')} AS avg_minutes
        FROM {DELTA} WHERE snapshot_date >= DATE '2024-01-30' - 28 GROUP BY snapshot_date""",
    "course_pattern": f"""
        SELECT c.course_title, count(*) AS week_count,
            {ratio('sum(weekly_study) FILTER (weekly_study > 0)', 'count(*) FILTER (weekly_study > 0)')} AS avg_weekly,
            max(weekly_study) AS max_weekly, c.progress_rate, c.total_lecture_time - c.study_time AS remaining,
            {hm('c.total_lecture_time - c.study_time')} AS remaining_hm
        FROM {DELTA} d JOIN courses c ON d.course_id = c.course_id
        GROUP BY d.course_id, c.course_title, c.progress_rate, c.total_lecture_time, c.study_time
        HAVING count(*) >= 2""",
    "goal_attainment": f"""
        SELECT max(snapshot_date) AS snapshot_date, sum(weekly_study) AS total_minutes,
            {hm('sum(weekly_study)')} AS total_hm, cast(180 as integer) AS goal_minutes,
            {ratio('sum(weekly_study) * 100', '180')} AS attainment_rate,
            CASE WHEN sum(weekly_study) >= 180 THEN '✅ 목표달성' WHEN sum(weekly_study) >= 120 THEN '⚠️ 양호'
                ELSE '❌ 미달성' END AS status
        FROM {DELTA} d JOIN courses c ON d.course_id = c.course_id WHERE d.snapshot_date = {NEWEST}""",
    "completion_forecast": f"""
        SELECT c.course_title, c.progress_rate, c.total_lecture_time - c.study_time AS remaining,
            {ratio('a.minutes', 'a.weeks')} AS avg_weekly,
            cast(ceil((c.total_lecture_time - c.study_time) * a.weeks / a.minutes) as bigint) AS weeks_left,
            DATE '2024-01-30' + cast(7 * ceil((c.total_lecture_time - c.study_time) * a.weeks / a.minutes) as integer) AS finish_date
        FROM courses c JOIN (SELECT course_id, sum(weekly_study) AS minutes, count(*) AS weeks FROM {DELTA}
            WHERE snapshot_date >= DATE '2024-01-30' - 28 AND weekly_study > 0 GROUP BY course_id) a
            ON a.course_id = c.course_id
        WHERE c.total_lecture_time > c.study_time""",
    "snapshot_history": f"""
        SELECT s.snapshot_date, c.course_title, s.progress_rate, s.study_time, s.total_lecture_time, s.created_at
        FROM {SEEN} s JOIN courses c ON s.course_id = c.course_id""",
    "idle_courses": f"""
        SELECT c.course_title, c.progress_rate, c.total_lecture_time - c.study_time AS remaining,
            max(s.snapshot_date) AS last_snapshot
        FROM courses c LEFT JOIN {SEEN} s ON s.course_id = c.course_id
        WHERE c.total_lecture_time > c.study_time
        GROUP BY c.course_id, c.course_title, c.progress_rate, c.total_lecture_time, c.study_time
        HAVING max(s.snapshot_date) < DATE '2024-01-30' - 14 OR max(s.snapshot_date) IS NULL""",
    "completed_today": f"""
        SELECT course_title, section_title, lecture_title, lecture_time, completed_at
        FROM lectures JOIN courses USING (course_id) WHERE {ON_DAY}""",
    "completed_today_stats": f"SELECT {STATS} FROM lectures WHERE {ON_DAY}",
    "completed_today_by_course": f"""
        SELECT course_title, {STATS} FROM lectures JOIN courses USING (course_id)
        WHERE {ON_DAY} GROUP BY course_id, course_title""",
    "completed_last_7d": f"""
        SELECT cast(completed_at as date) AS completed_date, course_title, section_title, lecture_title, lecture_time
        FROM lectures JOIN courses USING (course_id) WHERE {WITHIN.format(n=7)}""",
    "daily_stats_7d": f"""
        SELECT cast(completed_at as date) AS completed_date, dayname(completed_at) AS day_name, {STATS}
        FROM lectures WHERE {WITHIN.format(n=7)} GROUP BY 1, 2""",
    "completed_on": f"""
        SELECT course_title, section_title, lecture_title, lecture_time, strftime(completed_at, '%H:%M:%S') AS completed_time
        FROM lectures JOIN courses USING (course_id) WHERE {ON_DAY}""",
    "month_stats": f"""
        SELECT {STATS}, {ratio('count(*)', '30', 1)} AS per_day
        FROM lectures WHERE year(completed_at) = 1998 AND month(completed_at) = 6 AND completed_at < DATE '1998-06-14'""",
    "recent_completed": f"""
        SELECT {RECENT} FROM lectures JOIN courses USING (course_id)
        WHERE is_completed AND completed_at < DATE '1998-06-14' ORDER BY course_id, {ORDER} LIMIT 50""",
    "recent_completed_per_course": f"""
        SELECT course_id, cast(rank as integer) AS rank, {RECENT}
        FROM (SELECT *, row_number() OVER (PARTITION BY course_id ORDER BY {ORDER}) AS rank
              FROM lectures JOIN courses USING (course_id) WHERE is_completed AND completed_at < DATE '1998-06-14')
        WHERE rank <= 5""",
    "today_vs_yesterday": f"""
        SELECT '오늘' AS day_label, count(*) AS lecture_count, {ratio('sum(lecture_time)', '60')} AS study_hours
        FROM lectures WHERE {ON_DAY}
        UNION ALL
        SELECT '어제', count(*), {ratio('sum(lecture_time)', '60')}
        FROM lectures WHERE cast(completed_at as date) = DATE '1998-06-12'""",
    "weekday_pattern_30d": f"""
        SELECT dayname(completed_at) AS day_name, count(*) AS lecture_count,
            {ratio('sum(lecture_time)', 'count(*)')} AS avg_minutes
        FROM lectures WHERE {WITHIN.format(n=30)} GROUP BY dayname(completed_at)""",
    "visible_as_of": f"SELECT * FROM {SEEN}",
    "courses_to_update": "SELECT course_id, url FROM courses WHERE url IS NOT NULL AND is_target_course",
    "courses_to_update_stale": """
        SELECT course_id, url FROM courses WHERE url IS NOT NULL
            AND (updated_at < TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 1 DAY OR updated_at IS NULL)""",
    "course_lookup": "SELECT course_id, course_title, url FROM courses",
    "coverage_audit": f"SELECT * FROM {AUDIT}",
    "duplicate_keys": f"SELECT {KEY}, count(*) AS row_count FROM lectures GROUP BY {KEY} HAVING count(*) > 1",
    "duplicate_keys_unique": f"""
        SELECT {KEY}, count(*) AS row_count FROM lectures WHERE chapter_number IS NOT NULL
        GROUP BY {KEY} HAVING count(*) > 1""",
    "chapter_mix": """
        SELECT course_id, section_number, lecture_title,
            count(DISTINCT coalesce(cast(chapter_number as varchar), 'none')) AS chapter_keys, count(*) AS row_count
        FROM (SELECT * REPLACE ('Lecture ' || lecture_number AS lecture_title) FROM stored_lectures) GROUP BY ALL HAVING chapter_keys > 1""",
    "add_columns": """
        SELECT course_id, section_number, section_title, cast(NULL as integer) AS chapter_number,
            cast(NULL as varchar) AS chapter_title, cast(lecture_number as integer) AS lecture_number, lecture_title,
            lecture_time, is_completed, sort_order, cast(NULL as timestamp) AS completed_at
        FROM lectures""",
    "week_start": "SELECT event_id, cast(date_trunc('week', ts) as date) AS week FROM events",
    "completion_history": f"""
        SELECT {KEY}, last.is_completed, CASE WHEN last.is_completed THEN turned_done END AS completed_at
        FROM (SELECT {KEY}, arg_max(row, seq) AS last, max(CASE WHEN turned THEN observed_at END) AS turned_done
              FROM (SELECT *, o AS row, is_completed AND NOT coalesce(lag(is_completed) OVER
                        (PARTITION BY {KEY} ORDER BY observed_at, seq), false) AS turned FROM observations o)
              GROUP BY ALL)""",
    "upsert_courses": f"""
        SELECT coalesce(c.course_id, i.course_id) AS course_id,
            {', '.join(f'CASE WHEN i.course_id IS NULL THEN c.{f} ELSE i.{f} END AS {f}' for f in COURSE_VALUES.split(', '))},
            CASE WHEN i.course_id IS NULL THEN c.display_order END AS display_order,
            coalesce(c.is_target_course, false) AS is_target_course,
            CASE WHEN i.course_id IS NOT NULL AND c.course_id IS NOT NULL THEN TIMESTAMP '2024-01-31 00:00:00'
                ELSE c.updated_at END AS updated_at
        FROM courses c FULL JOIN {ITEMS} i ON c.course_id = i.course_id""",
    "upsert_snapshots": f"""
        SELECT coalesce(s.course_id, i.course_id) AS course_id,
            coalesce(s.snapshot_date, DATE '2024-01-29') AS snapshot_date,
            CASE WHEN i.course_id IS NULL THEN s.progress_rate ELSE i.progress_rate END AS progress_rate,
            CASE WHEN i.course_id IS NULL THEN s.study_time ELSE i.study_time END AS study_time,
            CASE WHEN i.course_id IS NULL THEN s.total_lecture_time ELSE i.total_lecture_time END AS total_lecture_time,
            coalesce(s.created_at, TIMESTAMP '2024-01-31 00:00:00') AS created_at
        FROM snapshots s FULL JOIN {ITEMS} i ON s.course_id = i.course_id AND s.snapshot_date = DATE '2024-01-29'""",
    "crawl_log": f"""
        SELECT course_id, 'success' AS crawl_status, cast(NULL as varchar) AS error_message,
            TIMESTAMP '2024-01-31 00:00:00' AS logged_at FROM {ITEMS}""",
    "upsert_lectures": folded("stored_lectures", BATCH),
    "replace_curriculum": f"""
        SELECT course_id, section_number, section_title, cast(chapter_number as integer) AS chapter_number,
            chapter_title, cast(lecture_number as integer) AS lecture_number, lecture_title, lecture_time, is_completed,
            sort_order, completed_at
        FROM lectures WHERE course_id NOT IN (SELECT doc_id FROM documents)
        UNION ALL
        SELECT course_id, section_number, 'Part ' || section_number, NULL, NULL, lecture_number, title,
            {strict('duration')}, false,
            cast(row_number() OVER (PARTITION BY course_id ORDER BY section_number, lecture_number) as integer), NULL
        FROM lessons WHERE chapter_number IS NULL""",
    "delete_lectures": f"SELECT {LECTURE_COLUMNS} FROM lectures WHERE course_id NOT IN (SELECT course_id FROM {AUDIT})",
    "count_deleted": f"SELECT count(*) AS deleted FROM lectures WHERE course_id IN (SELECT course_id FROM {AUDIT})",
    "recollect": f"""
        SELECT {LECTURE_COLUMNS} FROM lectures WHERE course_id NOT IN (SELECT course_id FROM {AUDIT})
        UNION ALL
        SELECT {LECTURE_COLUMNS} FROM ({folded(None, VALID)}) WHERE course_id IN (SELECT course_id FROM {AUDIT})""",
    "set_target": """
        SELECT course_id, course_title, progress_rate, study_time, total_lecture_time, url, display_order,
            CASE WHEN course_id IN (3, 7, 11) THEN true ELSE is_target_course END AS is_target_course, updated_at
        FROM courses""",
    "course_id_from_classroom": f"SELECT page_id, {CLASSROOM_ID.format(u='url')} AS text_id FROM page_text",
    "course_id_from_path": f"SELECT page_id, {PATH_ID.format(u='url')} AS course_id FROM page_text",
    "course_title": "SELECT page_id, course_title FROM titled",
    "page_metrics": "SELECT page_id, progress_rate, study_time, total_lecture_time FROM metrics",
    "parse_duration_daily": f"SELECT page_id, {daily('duration')} AS minutes FROM page_text",
    "parse_duration_full": f"SELECT page_id, {full('duration')} AS minutes FROM page_text",
    "parse_duration_strict": f"SELECT page_id, {strict('duration')} AS minutes FROM page_text",
    "rejected_durations": "SELECT page_id, duration FROM page_text WHERE duration = 'a:b'",
    "drop_unauthenticated": """
        SELECT page_id, url FROM page_text WHERE NOT contains(page_title, '인증') AND NOT contains(url, 'sign-in')""",
    "course_records": f"SELECT page_id, text_id AS course_id, {COURSE_VALUES} FROM course_items",
    "flatten_curriculum": f"""
        SELECT course_id, section_number, 'Part ' || section_number AS section_title, chapter_number,
            'Chapter ' || chapter_number AS chapter_title, lecture_number, title AS lecture_title,
            {daily('duration')} AS lecture_time, is_completed,
            cast(row_number() OVER (PARTITION BY course_id ORDER BY section_number, chapter_number, lecture_number)
                as integer) AS sort_order
        FROM lessons""",
    "flatten_curriculum_flat": f"""
        SELECT course_id, cast(dense_rank() OVER (PARTITION BY course_id ORDER BY section_number) as integer) AS section_number,
            'Part ' || section_number AS section_title, lecture_number, title AS lecture_title,
            {full('duration')} AS lecture_time, is_completed,
            cast(row_number() OVER (PARTITION BY course_id ORDER BY section_number, lecture_number) as integer) AS sort_order
        FROM lessons WHERE chapter_number IS NULL""",
    "section_summary": """
        SELECT l.course_id, l.section_number, count(*) AS lesson_count, count(*) FILTER (is_completed) AS complete_count,
            any_value(c.complete_count) AS declared_complete, any_value(c.total_count) AS total_count
        FROM lessons l JOIN counts c ON c.page_id = l.course_id AND c.section_number = l.section_number
        GROUP BY l.course_id, l.section_number""",
    "resolve_course_links": "SELECT page_id, position, url FROM links",
    "placeholder_courses": f"""
        SELECT page_id, {CLASSROOM_ID.format(u='url')} AS course_id, 'Course ' || {CLASSROOM_ID.format(u='url')} AS course_title,
            0.0::double AS progress_rate, 0.0::double AS study_time, 0.0::double AS total_lecture_time, url,
            position AS display_order
        FROM links""",
}


# Every column of every table after the batch, each under the name of its table.
AFTER_BATCH = " UNION ALL BY NAME ".join(
    f"SELECT '{kind}' AS kind, * FROM ({QUERIES[name]})" for kind, name in (
        ("courses", "upsert_courses"), ("course_progress_snapshots", "upsert_snapshots"),
        ("lectures", "upsert_lectures"), ("crawl_logs", "crawl_log")))
QUERIES |= {"apply_items": AFTER_BATCH, "stream_items": AFTER_BATCH}


# The given tables as the engine names their types.
DESCRIBED = {
    "lineitem": {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
        "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
        "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
    },
    "events": {"event_id": "bigint", "user_id": "bigint", "ts": "timestamp_ntz", "event_type": "string", "value": "double", "props": "string"},
    "documents": {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
}


def decoded(text: str) -> str:
    """Text with the entities of the raw pages replaced."""
    for entity, char in (("&quot;?", '"'), ("&#x27;?", "''"), ("&lt;?", "<"), ("&gt;?", ">"), ("&amp;?", "&")):
        text = f"regexp_replace({text}, '{entity}', '{char}', 'g')"
    return text


def outline(lists: bool) -> str:
    """One row per titled section; pages of one section come from their plain list, if that is read."""
    plain = """
        UNION ALL
        SELECT course_id, 'Section 1', list_transform(list_filter(found, lambda x: trim(x.t) <> ''), lambda x: trim(x.t) || '|-')
        FROM outline_sections WHERE course_id IN (SELECT course_id FROM single)
            AND len(list_filter(found, lambda x: trim(x.t) <> '')) > 0""" if lists else ""
    lesson = "trim(x.t) || '|' || CASE WHEN coalesce(x.d, '') = '' THEN '-' ELSE x.d END"
    return f"""
        SELECT course_id AS page_id, 'Course ' || course_id AS title,
            cast(count(*) OVER (PARTITION BY course_id) as integer) AS total_sections,
            cast(row_number() OVER (PARTITION BY course_id ORDER BY n) as integer) AS section_number,
            section, array_to_string(coalesce(texts, []), chr(10)) AS lessons
        FROM (SELECT course_id, section_number AS n, 'Part ' || section_number AS section,
                  list_transform(list_filter(found, lambda x: x.t <> ''), lambda x: {lesson}) AS texts
              FROM outline_sections WHERE section_number % 5 <> 0 AND course_id NOT IN (SELECT course_id FROM single)
              {plain.replace("SELECT course_id, 'Section 1'", "SELECT course_id, 1, 'Section 1'")})"""


QUERIES |= {
    "extract_listings": QUERIES["placeholder_courses"],
    "extract_curriculum_classroom": f"""
        SELECT page_id, section_number, 'Part ' || section_number AS section_title, chapter_number,
            'Chapter ' || chapter_number AS chapter_title, lecture_number, lecture_title,
            {daily('duration')} AS lecture_time, is_completed,
            cast(row_number() OVER (PARTITION BY page_id ORDER BY section_number, chapter_number, lecture_number)
                as integer) AS sort_order
        FROM classroom_lessons""",
    "extract_curriculum_classroom_flat": f"""
        SELECT page_id, cast(dense_rank() OVER (PARTITION BY page_id ORDER BY section_number) as integer) AS section_number,
            'Part ' || section_number AS section_title,
            cast(row_number() OVER (PARTITION BY page_id, section_number ORDER BY c, l) as integer) AS lecture_number,
            lecture_title, {full('duration')} AS lecture_time, is_completed,
            cast(row_number() OVER (PARTITION BY page_id ORDER BY section_number, c, l) as integer) AS sort_order
        FROM flat_lessons""",
    "extract_section_counts": """
        SELECT page_id, 'Part ' || section_number AS section, section_number,
            complete_count, CASE WHEN section_number % 9 = 0 THEN 99999999999 ELSE total_count END AS total_count
        FROM counts WHERE section_number % 7 <> 0 AND page_id % 97 <> 5""",
    "extract_curriculum_static": outline(lists=True),
    "extract_curriculum_outline": outline(lists=False),
    "extract_curriculum_purpose": outline(lists=False),
    "page_headings": f"""
        SELECT page_id, {decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS page_title,
            {shown(decoded("regexp_extract(html, '<h1>([^<]*)</h1>', 1)"))} AS h1, cast(0 as integer) AS sections
        FROM pages""",
    "rejected_pages": "SELECT doc_id AS page_id, 'no markup' AS rejected FROM documents WHERE doc_id % 97 = 5",
    "read_page_archive": "SELECT page_id, url, cast(length(html) as integer) AS length FROM pages",
    "read_table": f"SELECT {LECTURE_COLUMNS} FROM lectures",
    "write_feed": f"SELECT page_id AS seq, text_id AS course_id, {COURSE_VALUES} FROM course_items",
    "describe_table": " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{name}' AS col_name, '{kind}' AS data_type, true AS nullable,
            count({name}) AS filled FROM {table}"""
        for table, columns in DESCRIBED.items() for name, kind in columns.items()),
    "page_items": f"""
        SELECT 'course' AS item_type, course_id AS seq, 0 AS position, cast(course_id as varchar) AS course_id,
            'Course number ' || course_id AS course_title, cast(course_id % 101 as double) AS progress_rate,
            90.75::double AS study_time, 0.0::double AS total_lecture_time, '{SITE}/classroom/' || course_id AS url,
            cast(NULL as integer) AS section_number, cast(NULL as varchar) AS section_title, cast(NULL as integer) AS chapter_number, cast(NULL as integer) AS lecture_number,
            cast(NULL as varchar) AS lecture_title, cast(NULL as double) AS lecture_time,
            cast(NULL as boolean) AS is_completed, cast(NULL as integer) AS sort_order, false AS duration_rejected
        FROM (SELECT doc_id AS course_id FROM documents WHERE doc_id % 97 <> 5)
        UNION ALL
        SELECT 'lecture', page_id, sort_order, cast(page_id as varchar), 'Course number ' || page_id, NULL, NULL, NULL,
            NULL, section_number, 'Part ' || section_number, chapter_number, lecture_number, lecture_title,
            {daily('duration')}, is_completed, sort_order, duration = 'a:b'
        FROM (SELECT *, cast(row_number() OVER (PARTITION BY page_id
                  ORDER BY section_number, chapter_number, lecture_number) as integer) AS sort_order FROM classroom_lessons)""",
}

QUERIES["reread_pages"] = QUERIES["page_items"]
QUERIES["merged_history"] = QUERIES["completion_history"]
QUERIES["deliver_items"] = (
    "SELECT 'turn' AS item_type, conv_id AS seq, cast(turn as integer) AS position, text AS payload FROM conversations")
# Ranges of days: the report of each day of the range.
SNAPSHOT_RANGE = "(SELECT cast(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) as date) AS as_of)"
COMPLETION_RANGE = "(SELECT cast(unnest(generate_series(DATE '1998-05-15', DATE '1998-06-13', INTERVAL 1 DAY)) as date) AS as_of)"
QUERIES["trend_4w_days"] = f"""
    SELECT as_of, snapshot_date, count(DISTINCT course_id) AS course_count, sum(study_time) AS total_study,
        cast(cast(floor(sum(study_time) / 1440) as bigint) as varchar) || '일 ' ||
        cast(cast(floor((sum(study_time) % 1440) / 60) as bigint) as varchar) || '시간' AS total_dh,
        floor(cast(sum(cast(round(progress_rate * 100) as bigint)) as double) / count(*) + 0.5) / 100 AS avg_progress
    FROM {SNAPSHOT_RANGE} JOIN snapshots ON snapshot_date <= as_of AND snapshot_date >= as_of - 28 GROUP BY as_of, snapshot_date"""
QUERIES["idle_courses_days"] = f"""
    SELECT as_of, c.course_title, c.progress_rate, c.total_lecture_time - c.study_time AS remaining,
        max(s.snapshot_date) AS last_snapshot
    FROM {SNAPSHOT_RANGE} CROSS JOIN courses c LEFT JOIN snapshots s ON s.course_id = c.course_id AND s.snapshot_date <= as_of
    WHERE c.total_lecture_time > c.study_time
    GROUP BY as_of, c.course_id, c.course_title, c.progress_rate, c.total_lecture_time, c.study_time
    HAVING max(s.snapshot_date) < as_of - 14 OR max(s.snapshot_date) IS NULL"""
QUERIES["daily_stats_7d_days"] = f"""
    SELECT as_of, cast(completed_at as date) AS completed_date, dayname(completed_at) AS day_name, {STATS}
    FROM {COMPLETION_RANGE} JOIN lectures ON completed_at >= as_of - 7 AND completed_at < as_of + 1 GROUP BY 1, 2, 3"""
# The tables after the classroom pages, each of which is its course's only one.
PAGE_ITEMS = f"({QUERIES['page_items']})"
QUERIES["stream_pages"] = f"""
    SELECT 'courses' AS kind, cast(course_id as bigint) AS course_id, course_title, progress_rate, study_time, total_lecture_time, url,
        cast(NULL as integer) AS display_order, false AS is_target_course, cast(NULL as timestamp) AS updated_at, cast(NULL as date) AS snapshot_date,
        cast(NULL as timestamp) AS created_at, cast(NULL as integer) AS section_number, cast(NULL as varchar) AS section_title,
        cast(NULL as integer) AS chapter_number, cast(NULL as varchar) AS chapter_title, cast(NULL as integer) AS lecture_number,
        cast(NULL as varchar) AS lecture_title, cast(NULL as double) AS lecture_time, cast(NULL as boolean) AS is_completed,
        cast(NULL as integer) AS sort_order, cast(NULL as timestamp) AS completed_at, cast(NULL as varchar) AS crawl_status,
        cast(NULL as varchar) AS error_message, cast(NULL as timestamp) AS logged_at, cast(NULL as bigint) AS page_id, cast(NULL as varchar) AS rejected
    FROM {PAGE_ITEMS} WHERE item_type = 'course' AND course_id <> '0'
    UNION ALL BY NAME
    SELECT 'course_progress_snapshots' AS kind, cast(course_id as bigint) AS course_id, DATE '2024-01-29' AS snapshot_date, progress_rate, study_time,
        total_lecture_time, TIMESTAMP '2024-01-31 00:00:00' AS created_at
    FROM {PAGE_ITEMS} WHERE item_type = 'course' AND course_id <> '0'
    UNION ALL BY NAME
    SELECT 'lectures' AS kind, cast(course_id as bigint) AS course_id, section_number, section_title, chapter_number,
        'Chapter ' || chapter_number AS chapter_title, lecture_number, lecture_title, lecture_time, is_completed, sort_order,
        CASE WHEN is_completed THEN TIMESTAMP '2024-01-31 00:00:00' END AS completed_at
    FROM {PAGE_ITEMS} WHERE item_type = 'lecture'
    UNION ALL BY NAME
    SELECT 'crawl_logs' AS kind, cast(course_id as bigint) AS course_id, 'success' AS crawl_status, TIMESTAMP '2024-01-31 00:00:00' AS logged_at
    FROM {PAGE_ITEMS} WHERE item_type = 'course' AND course_id <> '0'
    UNION ALL BY NAME
    SELECT 'rejected_pages' AS kind, page_id, '{SITE}/classroom/' || page_id AS url, rejected, TIMESTAMP '2024-01-31 00:00:00' AS logged_at
    FROM ({QUERIES['rejected_pages']})"""

QUERIES["kept_weeks"] = QUERIES["weekly_delta"]
QUERIES["kept_days"] = f"""
    SELECT course_id, cast(completed_at as date) AS completed_date, is_completed, count(*) AS lecture_count,
        count(lecture_time) AS timed_count, sum(lecture_time) AS study_minutes
    FROM ({QUERIES['upsert_lectures']}) GROUP BY ALL"""
LECTURE_COLUMNS = f"{KEY}, section_title, chapter_title, lecture_title, lecture_time, is_completed, sort_order, completed_at"
CAME = f"""(
    SELECT *, CASE WHEN is_completed THEN observed_at END AS completed_at,
        EXISTS (SELECT 1 FROM stored_lectures s WHERE {same_key('s', 'o')}) AS held,
        row_number() OVER (PARTITION BY {KEY} ORDER BY seq) AS place
    FROM observations o WHERE observed_at >= DATE '2024-01-16')"""
QUERIES["insert_lectures"] = f"""
    SELECT 'lectures' AS kind, {LECTURE_COLUMNS}, cast(NULL as bigint) AS seq, cast(NULL as varchar) AS reason, cast(NULL as timestamp) AS logged_at
    FROM (SELECT {LECTURE_COLUMNS} FROM stored_lectures UNION ALL SELECT {LECTURE_COLUMNS} FROM {CAME} WHERE NOT held AND place = 1)
    UNION ALL
    SELECT 'rejected_lectures', {LECTURE_COLUMNS}, seq, CASE WHEN held THEN 'key is stored' ELSE 'key came earlier' END,
        TIMESTAMP '2024-01-31 00:00:00'
    FROM {CAME} WHERE held OR place > 1"""


def oracle_sql() -> dict[str, str]:
    return {name: query(sql) for name, sql in QUERIES.items()}
