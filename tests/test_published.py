import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from coursepulse.plans.update import apply_items, publish_items
from coursepulse.sources import readers, writers
from coursepulse.sources.published import CommitConflict, PublishedTables
from coursepulse.sources.schemas import ITEMS, TABLES
from coursepulse.sources.scratch import scratch_folder
from coursepulse.streaming.items import stream_items

from .conftest import values
from .test_maintenance import NOW, course, items, lecture


def batch(spark, first, *rows):
    return items(spark, *rows).withColumn("seq", F.col("seq") + first)


def test_commits_rewrite_only_touched_parts(spark, tmp_path):
    tables = PublishedTables(spark, str(tmp_path), buckets=8)
    assert tables.newest().number == 0 and tables.read("lectures").count() == 0
    first = items(spark, *[course(f"https://x/classroom/{i}") for i in range(1, 30)],
                  *[lecture(str(i), 1, None, 1, False) for i in range(1, 30)])
    assert publish_items(tables, first, NOW) == 1
    before = tables.newest()
    assert publish_items(tables, items(spark, lecture("3", 1, None, 1, True)), "2024-02-01 00:00:00") == 2
    after = tables.newest()
    moved = {key for key in after.paths if after.paths[key] != before.paths.get(key)}
    assert len([key for key in moved if key[0] == "lectures"]) == 1
    assert not [key for key in moved if key[0] == "courses"]
    assert tables.read("lectures").count() == 29
    assert values(tables.read("lectures").filter("is_completed").select("course_id", F.col("completed_at").cast("string"))) == [
        (3, "2024-02-01 00:00:00")]
    assert tables.read("crawl_logs").count() == 29 and tables.read("course_progress_snapshots").count() == 29
    # The older state is still whole.
    assert tables.read("lectures", commit=before).filter("is_completed").count() == 0


def ids(df):
    return sorted(r.course_id for r in df.collect())


def test_leftovers_of_a_failed_commit_are_not_seen(spark, tmp_path):
    tables = PublishedTables(spark, str(tmp_path), buckets=2)
    publish_items(tables, items(spark, course("https://x/classroom/1")), NOW)
    for name in ("crawl_logs", "courses"):  # written, but the manifest never came
        tables._write(name, tables.read(name))
    assert publish_items(tables, items(spark, lecture("1", 1, None, 1, True)), NOW) == 2
    assert ids(tables.read("crawl_logs")) == [1] and ids(tables.read("courses")) == [1]
    assert publish_items(tables, items(spark, course("https://x/classroom/2")), NOW) == 3
    assert ids(tables.read("crawl_logs")) == [1, 2]


def test_logs_can_be_read_before_there_are_any(spark, tmp_path):
    tables = PublishedTables(spark, str(tmp_path), buckets=2)
    publish_items(tables, items(spark, lecture("1", 1, None, 1, True)), NOW)
    assert tables.read("crawl_logs").count() == 0


def test_batches_are_known_by_their_stream(spark, tmp_path):
    tables = PublishedTables(spark, str(tmp_path), buckets=2)
    def bring(n, mark=None):
        publish_items(tables, items(spark, course(f"https://x/classroom/{n}")), NOW, mark)
        return ids(tables.read("crawl_logs"))
    assert bring(1, ("a", 5)) == [1]
    assert bring(2, ("b", 0)) == [1, 2]  # another stream, or the same one under a new checkpoint
    assert bring(3) == [1, 2, 3]  # a batch without a stream leaves the marks alone
    assert bring(4, ("a", 5)) == [1, 2, 3]
    assert bring(4, ("a", 6)) == [1, 2, 3, 4]
    assert tables.newest().marks == {"a": 6, "b": 0}


def test_the_stored_bucket_count_holds(spark, tmp_path):
    rows = items(spark, *[lecture(str(i), 1, None, 1, False) for i in range(8)])
    publish_items(PublishedTables(spark, str(tmp_path), buckets=16), rows, NOW)
    with pytest.raises(ValueError, match="16 buckets"):
        publish_items(PublishedTables(spark, str(tmp_path), buckets=8), rows, NOW)
    again = PublishedTables(spark, str(tmp_path))
    publish_items(again, rows, NOW)
    assert again.read("lectures").count() == 8
    again.rebucket("lectures", 3)
    assert again.newest().buckets["lectures"] == 3 and again.read("lectures").count() == 8
    publish_items(again, rows, NOW)
    assert again.read("lectures").count() == 8


def test_of_two_writers_one_is_refused(spark, tmp_path):
    tables = PublishedTables(spark, str(tmp_path), buckets=2)
    seen = tables.newest()
    log = spark.createDataFrame([(5, 1, "success", None, None)], TABLES["crawl_logs"])
    assert tables.publish({"crawl_logs": (log, [])}, seen) == 1
    with pytest.raises(CommitConflict):
        tables.publish({"crawl_logs": (log, [])}, seen)
    assert tables.read("crawl_logs").count() == 1


def test_other_records_are_passed_on(spark, tmp_path):
    got = []
    publish_items(PublishedTables(spark, str(tmp_path), buckets=2), items(spark, course("https://x/classroom/1"), {
        "item_type": "outline", "payload": "{}"}), NOW, pass_on=lambda rows: got.extend(rows.collect()))
    assert [r.payload for r in got] == ["{}"]


def test_a_batch_is_evaluated_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)
    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch
    rows = items(spark, course("https://x/classroom/1"), lecture("1", 1, None, 1, True))
    publish_items(PublishedTables(spark, str(tmp_path), buckets=2), rows.mapInArrow(count, rows.schema), NOW)
    assert read.value == 2


def test_many_small_commits_stay_bounded(spark, tmp_path):
    tables = PublishedTables(spark, str(tmp_path), buckets=1, keep=3)
    for n in range(40):
        log = spark.createDataFrame([(n, n, "success", None, None)], TABLES["crawl_logs"])
        tables.publish({"crawl_logs": (log.coalesce(1), [])})
    assert len(tables.numbers()) == 3
    assert len(os.listdir(f"{tmp_path}/crawl_logs")) < 2 * 16 + 3
    assert ids(tables.read("crawl_logs")) == list(range(40))
    assert ids(tables.read("crawl_logs", commit=tables.at(39))) == list(range(39))


def test_stream_equals_batches(spark, tmp_path):
    batches = [
        [course("https://x/classroom/1"), lecture("1", 1, None, 1, True), lecture("1", 1, None, 2, False)],
        [lecture("1", 1, None, 1, False), lecture("1", 1, None, 2, True), course("https://x/classroom/1", "new title here")],
        [lecture("1", 1, None, 1, True), course("https://x/classroom/2"), {"item_type": "other"}],
    ]
    state = {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}
    for number, rows in enumerate(batches):
        df = batch(spark, number * 100, *rows)
        df.coalesce(1).write.parquet(f"{tmp_path}/in/{number}")
        # Streams read files oldest first.
        for file in os.listdir(f"{tmp_path}/in/{number}"):
            os.utime(f"{tmp_path}/in/{number}/{file}", (1_700_000_000 + number * 60,) * 2)
        state = apply_items(state, df, NOW)
    tables = PublishedTables(spark, f"{tmp_path}/tables", buckets=4)
    stream = spark.readStream.schema(ITEMS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    stream_items(stream, tables, f"{tmp_path}/checkpoint", NOW).awaitTermination()
    assert tables.newest().number == 3
    for name, df in state.items():
        assert values(tables.read(name).select(df.columns)) == values(df), name


def test_table_and_feed_round_trip(spark, tmp_path):
    rows = items(spark, course("https://x/classroom/1", "제목 하나입니다"))
    writers.write_feed(rows, f"{tmp_path}/feed")
    text = "".join(open(f"{tmp_path}/feed/{f}", encoding="utf-8").read() for f in os.listdir(f"{tmp_path}/feed") if f.endswith("json"))
    assert "제목 하나입니다" in text
    assert values(readers.read_page_archive(spark, f"{tmp_path}/feed", "json", ITEMS)) == values(rows)
    log = spark.createDataFrame([(5, 1, "success", None, None)], TABLES["crawl_logs"])
    for _ in range(2):
        writers.append_crawl_log(log, f"{tmp_path}/crawl_logs")
    assert readers.read_table(spark, str(tmp_path), "crawl_logs").count() == 2


def test_old_files_read_with_the_new_columns(spark, tmp_path):
    spark.createDataFrame([(1, 1, "Part", 1, "L", 2.0)],
        "course_id BIGINT, section_number INT, section_title STRING, lecture_number INT, lecture_title STRING, lecture_time DOUBLE"
    ).write.parquet(f"{tmp_path}/lectures")
    row = readers.read_table(spark, str(tmp_path), "lectures").first()
    assert (row.lecture_time, row.chapter_number, row.completed_at) == (2.0, None, None)


def test_scratch_folders_are_where_the_cluster_says():
    class Session:
        def __init__(self, folder, master):
            self.conf = {"spark.checkpoint.dir": folder} if folder else {}
            self.sparkContext = SimpleNamespace(master=master, applicationId="app-1")

    assert scratch_folder(Session("hdfs://x/shared/", "yarn"), "t").startswith("hdfs://x/shared/app-1/t-")
    assert scratch_folder(Session(None, "local[2]"), "t").startswith("file:///")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://x:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_folder(Session(None, master), "t")


def test_records_are_passed_on_until_it_succeeds(spark, tmp_path):
    """A receiver that fails gets them when the batch is replayed, or with the next batch; nothing is applied twice."""
    tables = PublishedTables(spark, str(tmp_path), buckets=2)
    got, fail = [], [True]

    def take(rows):
        if fail[0]:
            raise RuntimeError("receiver is away")
        got.extend(r.payload for r in rows.collect())

    def bring(n, payload, batch):
        return publish_items(tables, items(spark, course(f"https://x/classroom/{n}"), {"item_type": "outline", "payload": payload}),
                             NOW, ("s", batch), take)

    with pytest.raises(RuntimeError, match="away"):
        bring(1, "a", 0)
    assert ids(tables.read("courses")) == [1] and len(tables.newest().outbox) == 1
    fail[0] = False
    bring(1, "a", 0)
    assert got == ["a"] and ids(tables.read("crawl_logs")) == [1] and not tables.newest().outbox
    fail[0] = True
    with pytest.raises(RuntimeError):
        bring(2, "b", 1)
    fail[0] = False
    bring(3, "c", 2)  # the batch before was not replayed; its records come first
    assert got == ["a", "b", "c"] and ids(tables.read("courses")) == [1, 2, 3]
    bring(3, "c", 2)
    assert got == ["a", "b", "c"]


def test_a_stream_passes_on_after_a_restart(spark, tmp_path):
    tables = PublishedTables(spark, f"{tmp_path}/tables", buckets=2)
    items(spark, course("https://x/classroom/1"), {"item_type": "outline", "payload": "x"}).coalesce(1).write.parquet(f"{tmp_path}/in")
    got = []

    def away(rows):
        raise RuntimeError("receiver is away")

    def start(take):
        return stream_items(spark.readStream.schema(ITEMS).parquet(f"{tmp_path}/in"), tables, f"{tmp_path}/checkpoint", NOW, pass_on=take)

    with pytest.raises(Exception, match="away"):
        start(away).awaitTermination()
    start(lambda rows: got.extend(rows.collect())).awaitTermination()
    assert [r.item_type for r in got] == ["outline"]
    assert ids(tables.read("crawl_logs")) == [1]


def meeting(tables, monkeypatch, between):
    """Let ``between`` publish after the tables were read and before the next commit."""
    real, once = PublishedTables._commit, []

    def commit(self, new):
        if not once:
            once.append(1)
            between()
        return real(self, new)

    monkeypatch.setattr(PublishedTables, "_commit", commit)


def test_a_writer_of_other_parts_is_rebased(spark, tmp_path, monkeypatch):
    """What was written stays good; nothing is made again."""
    tables = PublishedTables(spark, str(tmp_path), buckets=64)
    publish_items(tables, items(spark, *[lecture(str(c), 1, None, 1, False) for c in range(1, 9)]), NOW)
    meeting(tables, monkeypatch, lambda: publish_items(tables, items(spark, lecture("2", 1, None, 1, True)), NOW))
    writes = []
    real = PublishedTables._write_parts
    monkeypatch.setattr(PublishedTables, "_write_parts", lambda self, *a: writes.append(a[0]) or real(self, *a))
    assert publish_items(tables, items(spark, lecture("1", 1, None, 1, True)), NOW) == 3
    assert writes == ["lectures"] * 2  # one each
    assert ids(tables.read("lectures").filter("is_completed")) == [1, 2]


def test_a_writer_of_the_same_parts_starts_again(spark, tmp_path, monkeypatch):
    tables = PublishedTables(spark, str(tmp_path), buckets=1)
    publish_items(tables, items(spark, course("https://x/classroom/1")), NOW)
    meeting(tables, monkeypatch, lambda: publish_items(tables, items(spark, course("https://x/classroom/2")), NOW))
    publish_items(tables, items(spark, course("https://x/classroom/3")), NOW)
    assert ids(tables.read("courses")) == ids(tables.read("crawl_logs")) == ids(tables.read("course_progress_snapshots")) == [1, 2, 3]


def test_a_batch_that_another_run_of_the_stream_brought_is_skipped(spark, tmp_path, monkeypatch):
    tables = PublishedTables(spark, str(tmp_path), buckets=64)
    rows = items(spark, lecture("1", 1, None, 1, True))
    meeting(tables, monkeypatch, lambda: publish_items(tables, rows, NOW, ("s", 0)))
    assert publish_items(tables, rows, NOW, ("s", 0)) == 1
    assert tables.read("lectures").count() == 1


@pytest.mark.parametrize("same", [False, True])
def test_two_streams_at_once(spark, tmp_path, same):
    """Both finish, into other courses or the same ones, and none of their records is lost."""
    tables = PublishedTables(spark, f"{tmp_path}/tables", buckets=4, keep=50)
    streams = []
    for s in range(2):
        for n in range(3):
            number = n if same else 10 * s + n
            rows = batch(spark, n * 10, course(f"https://x/classroom/{number + 1}"), lecture(str(number + 1), 1, s, 1, True))
            rows.coalesce(1).write.parquet(f"{tmp_path}/in{s}/{n}")
        source = spark.readStream.schema(ITEMS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in{s}/*")
        streams.append(stream_items(source, tables, f"{tmp_path}/checkpoint{s}", NOW))
    for query in streams:
        query.awaitTermination()
    want = sorted({(n if same else 10 * s + n) + 1 for s in range(2) for n in range(3)})
    assert ids(tables.read("courses")) == want
    assert tables.read("lectures").count() == 6 and tables.read("crawl_logs").count() == 6
    assert sorted(tables.newest().marks.values()) == [2, 2]


def test_no_folder_is_left_behind(spark, tmp_path, monkeypatch):
    """After refused commits and many small ones only the folders that a kept commit names are there."""
    tables = PublishedTables(spark, str(tmp_path), buckets=2, keep=2)
    for n in range(4):
        publish_items(tables, items(spark, course(f"https://x/classroom/{n + 1}"), lecture(str(n + 1), 1, None, 1, True),
                                    {"item_type": "outline"}), NOW, pass_on=lambda rows: None)
    seen = tables.at(tables.numbers()[0])
    every = (tables.read("courses"), ["0", "1"])
    with pytest.raises(CommitConflict):
        tables.publish({"courses": every}, seen, others=tables.read("courses"))
    assert tables.publish({"courses": every}, seen, rebase=True) == tables.newest().number  # only the outbox was changed since
    with pytest.raises(CommitConflict):
        tables.publish({"courses": every}, seen, others=tables.read("courses"), rebase=True)
    kept = set().union(*(tables.at(n).folders() for n in tables.numbers()))
    named = {path.removeprefix(str(tmp_path) + "/").split("/part=")[0] for path in kept}
    there = {f"{name}/{folder}" for name in (*TABLES, "outbox", "staging") if os.path.isdir(f"{tmp_path}/{name}")
             for folder in os.listdir(f"{tmp_path}/{name}")}
    assert there == named
    assert len(os.listdir(f"{tmp_path}/manifests")) == 2


def test_clearing_up_cannot_fail_a_commit(spark, tmp_path, monkeypatch):
    tables = PublishedTables(spark, str(tmp_path), buckets=1, keep=1)
    publish_items(tables, items(spark, course("https://x/classroom/1")), NOW)
    monkeypatch.setattr(PublishedTables, "_remove", lambda *a: 1 / 0)
    assert publish_items(tables, items(spark, course("https://x/classroom/2")), NOW) == 2
    monkeypatch.undo()
    assert ids(tables.read("courses")) == [1, 2] and tables.expire() and tables.numbers() == [2]


def test_a_manifest_written_before_there_was_an_outbox(spark, tmp_path):
    from coursepulse.sources.published import Commit
    assert Commit.from_text('{"number": 3, "paths": [], "buckets": {}, "marks": {}}').outbox == {}


def test_pages_come_as_a_stream(spark, tmp_path):
    """Each page is read once; records and rejected pages are one commit; the tables are those of a batch."""
    from coursepulse.plans.collect import page_items
    from coursepulse.streaming.items import stream_pages

    def page(number, done):
        clip = "classroom-sidebar-clip__chapter"
        return (number, f"https://x/classroom/{number}", f"<title>t</title><h1>Course number {number}</h1><div class='{clip}'><p class='{clip}__title'>S</p>"
                f"<div class='{clip}__clip{f' {clip}__clip--complete' if done else ''}'><span class='{clip}__clip__title'>L</span></div></div>")

    schema = "page_id long, url string, html string"
    parts = [[page(1, True), (2, "https://x/classroom/2", None)], [(3, "https://x/classroom/3", None), page(4, False)], [page(5, True)]]
    tables = PublishedTables(spark, f"{tmp_path}/tables", buckets=2)
    for number, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/pages")
        stream_pages(spark.readStream.schema(schema).parquet(f"{tmp_path}/pages"), tables, f"{tmp_path}/checkpoint", NOW).awaitTermination()
        assert tables.newest().number == number + 1
    whole = spark.createDataFrame(sum(parts, []), schema)
    state = {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}
    for name, df in apply_items(state, page_items(whole), NOW).items():
        assert values(tables.read(name).select(df.columns)) == values(df), name
    assert values(tables.read("rejected_pages").select("page_id", "url", "rejected")) == [
        (n, f"https://x/classroom/{n}", "no markup") for n in (2, 3)]
    assert tables.read("courses").count() == 3
    both = page_items(whole, rejects=True)
    assert values(both.filter("item_type <> 'rejected_page'")) == values(page_items(whole))


def folders_of(tables, name="lectures"):
    return {part: path for (table, part), path in tables.newest().paths.items() if table == name}


def test_new_sections_come_beside_what_is_stored(spark, tmp_path):
    """Only a batch that meets stored rows writes their part again; a part of many folders is written whole."""
    tables = PublishedTables(spark, str(tmp_path), buckets=1)
    state = {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}

    def bring(n, *rows):
        publish_items(tables, batch(spark, n * 100, *rows), NOW)
        state["lectures"] = spark.createDataFrame(apply_items(state, batch(spark, n * 100, *rows), NOW)["lectures"].collect(), TABLES["lectures"])
        assert values(tables.read("lectures")) == values(state["lectures"])
        return folders_of(tables)["0"]

    first = bring(0, lecture("1", 1, None, 1, False), lecture("1", 1, 2, 1, True))
    second = bring(1, lecture("2", 1, None, 1, True), lecture("2", 1, None, 1, False), lecture("2", None, None, 1, True))
    third = bring(2, lecture("1", 2, None, 1, True))
    assert len(first) == 1 and second[:1] == first and third[:2] == second and len(third) == 3
    assert len(bring(3, lecture("1", 1, None, 1, True), lecture("7", 1, None, 1, True))) == 1
    # A key without a section meets nothing, so it stays a row of its own.
    assert len(bring(4, lecture("2", None, None, 1, True))) == 2
    for n in range(5, 19):
        assert len(bring(n, lecture(str(10 + n), 1, None, 1, False))) == n - 2
    assert len(bring(19, lecture("90", 1, None, 1, False))) == 1


def test_a_row_that_comes_beside_does_not_hide_a_conflict(spark, tmp_path, monkeypatch):
    tables = PublishedTables(spark, str(tmp_path), buckets=1)
    tables.maintain("completion_days")
    publish_items(tables, items(spark, lecture("1", 1, None, 1, False)), NOW)
    meeting(tables, monkeypatch, lambda: publish_items(tables, items(spark, lecture("2", 1, None, 1, True)), NOW))
    publish_items(tables, items(spark, lecture("2", 1, None, 1, True), lecture("3", 1, None, 1, True)), NOW)
    assert ids(tables.read("lectures")) == [1, 2, 3] and ids(tables.read("completion_days")) == [1, 2, 3]
    kept = set().union(*(tables.at(n).folders() for n in tables.numbers()))
    assert {path.split("/part=")[0] for path in kept if "/lectures/" in path} == {
        f"{tmp_path}/lectures/{folder}" for folder in os.listdir(f"{tmp_path}/lectures")}


def test_manifests_with_one_folder_a_part_are_read(spark, tmp_path):
    from coursepulse.sources.published import Commit
    old = Commit.from_text('{"number": 3, "paths": [["lectures", "0", "/a"]], "buckets": {}, "marks": {}}')
    assert old.paths == {("lectures", "0"): ("/a",)} and '"/a"' in old.to_text()
    two = Commit(4, {("lectures", "0"): ("/a", "/b")})
    assert Commit.from_text(two.to_text()) == two and two.folders() == {"/a", "/b"}


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_commit_leaves_no_shuffle_files(spark, tmp_path):
    import time

    tables = PublishedTables(spark, str(tmp_path), buckets=2)
    before = shuffle_files(spark)
    for n in range(2):
        publish_items(tables, items(spark, course("https://x/classroom/1"), lecture("1", 1, None, n, True)), NOW)
    for _ in range(20):  # they go in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.5)
    assert not left
    from coursepulse.sources.scratch import CLEANUP_SETTING
    assert spark.conf.get(CLEANUP_SETTING, None) is None
