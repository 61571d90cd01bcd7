"""The tables as Parquet under one root, changed together by numbered commits.

A commit writes new folders for the parts of the tables it changes and then one manifest that names the folder of every
part, the bucket counts, the last batch of every stream and the outbox. A manifest appears under its number in one step that
fails if the number is taken, so of two writers one is refused, and readers see all of a commit or nothing of it. That
step is a hard link on a local disk and a rename on HDFS; an object store whose rename is a copy cannot refuse, so
there must be one writer at a time there. A refused writer may rebase: what it has written stays good if no part that it
read or replaces was changed in between. What a refused commit has written is removed.

No file that is being read is overwritten; all folders have unique names. Courses are parted by a hash of the course, lectures by a
hash of course and section (so that a large course spreads), snapshots by week; rows of the tables that only grow are added
as folders of their own, of which full levels are merged. Rows that meet nothing stored in their part may be added to it as a folder
beside those it has; a part of ``PART_FOLDERS`` folders is due to be written whole. Commits older than the ``keep`` newest are removed with what only
they hold, so manifests and folders stay bounded.

Kept tables (``operators.kept``) follow from others. Once ``maintain`` has made one, every commit, whoever writes it, also
holds the parts of it that change with the parts it replaces, so readers never see the one without the other.

The outbox holds records that no table takes until somebody else has them: an entry is part of the commit of its batch
and stays until it is acknowledged, so a failure in between gives it out again.
"""

from __future__ import annotations

import dataclasses
import json
import re
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.kept import RULES
from .schemas import TABLES
from .scratch import PACKED, lean

#: Tables whose rows are only added.
GROWING = ("crawl_logs", "rejected_pages", "rejected_lectures")
BUCKETED = ("courses", "lectures")
OUTBOX = "outbox"
#: Log folders of one level that are merged into one of the next.
LOG_FOLDERS = 16
#: Folders of a part with which it is written whole again.
PART_FOLDERS = 16


class CommitConflict(RuntimeError):
    """Another writer has published since the tables were read; nothing of this commit is visible."""


@dataclasses.dataclass(frozen=True)
class Commit:
    """Newest commit: its number, (table, part) to its folders, oldest first, bucket counts, the last batch per stream, the
    folders of the outbox by entry, oldest first, and the kept tables."""

    number: int = 0
    paths: dict[tuple[str, str], tuple[str, ...]] = dataclasses.field(default_factory=dict)
    buckets: dict[str, int] = dataclasses.field(default_factory=dict)
    marks: dict[str, int] = dataclasses.field(default_factory=dict)
    outbox: dict[str, str] = dataclasses.field(default_factory=dict)
    kept: tuple[str, ...] = ()

    def to_text(self) -> str:
        parts = [[table, part, path[0] if len(path) == 1 else path] for (table, part), path in sorted(self.paths.items())]
        return json.dumps({"number": self.number, "paths": parts, "buckets": self.buckets, "marks": self.marks,
                           "outbox": self.outbox, "kept": self.kept})

    @classmethod
    def from_text(cls, text: str) -> Commit:
        found = json.loads(text)
        paths = {(t, p): (path,) if isinstance(path, str) else tuple(path) for t, p, path in found["paths"]}
        return cls(found["number"], paths, found["buckets"], found["marks"],
                   found.get("outbox", {}), tuple(found.get("kept", ())))

    def folders(self) -> set[str]:
        return {*_folders(self.paths), *self.outbox.values()}


def _folders(paths: dict[tuple[str, str], tuple[str, ...]]) -> list[str]:
    return [folder for each in paths.values() for folder in each]


class PublishedTables:
    """Reader and writer of the published tables.

    ``buckets``: parts of the courses and of the lectures table, chosen when the tables are created so that a part is
    a few hundred MB, and stored; a different number for existing tables is refused (``rebucket`` changes it).
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None, keep: int = 8):
        self.spark, self.root, self.asked, self.keep = spark, root.rstrip("/"), buckets, keep
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def buckets_of(self, commit: Commit) -> dict[str, int]:
        """Bucket counts: the stored ones, or the asked (64 by default) for new tables."""
        for name, stored in commit.buckets.items():
            if self.asked not in (None, stored):
                raise ValueError(f"{name} is stored in {stored} buckets, not {self.asked}; use rebucket to change it")
        return commit.buckets or dict.fromkeys(BUCKETED, self.asked or 64)

    def part_of(self, name: str, buckets: dict[str, int]) -> Column:
        """Part a row of a keyed table belongs to."""
        if name not in BUCKETED:
            return F.coalesce(F.col("snapshot_date").cast("string"), F.lit("none"))
        key = ["course_id", "section_number"] if name == "lectures" else ["course_id"]
        return F.pmod(F.xxhash64(*key), F.lit(buckets[name])).cast("string")

    def numbers(self) -> list[int]:
        """Numbers of the stored commits; there are at most a few more than ``keep``."""
        folder = self._hadoop.Path(f"{self.root}/manifests")
        files = self._fs.listStatus(folder) if self._fs.exists(folder) else []
        found = (re.fullmatch(r"(\d+)\.json", file.getPath().getName()) for file in files)
        return sorted(int(m[1]) for m in found if m)

    def newest(self) -> Commit:
        numbers = self.numbers()
        return self.at(numbers[-1]) if numbers else Commit()

    def at(self, number: int) -> Commit:
        """A stored commit."""
        stream = self._fs.open(self._hadoop.Path(self._manifest(number)))
        try:
            return Commit.from_text(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, name: str, parts: Iterable[str] | None = None, commit: Commit | None = None) -> DataFrame:
        """A table, or only the given parts of it, as of the newest or a given commit."""
        commit = commit or self.newest()
        paths = [folder for (table, part), path in sorted(commit.paths.items())
                 if table == name and (parts is None or part in parts) for folder in path]
        if not paths:
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(*paths)

    def touched(self, name: str, rows: DataFrame, commit: Commit) -> list[str]:
        """Parts the rows fall into; never more than there are buckets or weeks."""
        return self.touched_by({name: rows}, commit)[name]

    def touched_by(self, changes: dict[str, DataFrame], commit: Commit) -> dict[str, list[str]]:
        """``touched`` for several tables in one job. Rows of growing tables and of the outbox fall into one part."""
        buckets, found = self.buckets_of(commit), None
        for name, rows in changes.items():
            part = F.lit("new") if name in (*GROWING, OUTBOX) else self.part_of(name, buckets)
            own = rows.select(F.lit(name).alias("name"), part.alias("part"))
            found = own if found is None else found.unionByName(own)
        parts: dict[str, list[str]] = {name: [] for name in changes}
        with lean(found.sparkSession):
            for r in found.distinct().collect():
                parts[r["name"]].append(r["part"])
        return {name: sorted(each) for name, each in parts.items()}

    def to_rewrite(self, name: str, rows: DataFrame, key: list[str], parts: list[str], commit: Commit) -> list[str]:
        """Of ``parts`` those that have to be written whole with ``rows``: they hold a row of the same ``key`` (NULL meets nothing), or
        have ``PART_FOLDERS`` folders. Rows of the others can be added beside what is stored."""
        folders = {part: len(commit.paths.get((name, part), ())) for part in parts}
        due = [part for part in parts if folders[part] >= PART_FOLDERS]
        asked = [part for part in parts if 0 < folders[part] < PART_FOLDERS]
        if asked:
            # Keys are made distinct before they are shuffled, and nothing else is.
            stored = self.read(name, asked, commit).withColumn("part", self.part_of(name, self.buckets_of(commit)))
            met = stored.select(*key, "part").distinct().join(rows.select(*key).distinct(), key, "left_semi")
            with lean(self.spark):
                due += [r["part"] for r in met.select("part").distinct().collect()]
        return sorted(due)

    def publish(
        self, changes: dict[str, tuple[DataFrame, list[str]]], commit: Commit | None = None,
        mark: tuple[str, int] | None = None, others: DataFrame | None = None, rebase: bool = False, added: Iterable[str] = (),
    ) -> int:
        """Replace the listed parts of each table and publish all of it under the next number.

        A table's entry is its new content for those parts and the list of parts; rows of growing tables are added, and of the
        tables in ``added`` those that fall into parts that are not listed. ``mark`` is a
        stream's name and the batch it has come to; the marks of other streams stay. ``others`` go to the outbox. ``commit`` is
        the state that the changes were made from. If another has been published since, ``CommitConflict`` is raised, or
        with ``rebase`` only if that one changed a part that is replaced here, the buckets, or the mark of this stream;
        otherwise the changes go on top of it as they are.
        """
        base = commit or self.newest()
        buckets = self.buckets_of(base)
        replaced = {(name, part) for name, (_, parts) in changes.items() for part in parts if name not in GROWING}
        written = self._write_all(changes, buckets)
        beside = {key for key in written if key[0] in added} - replaced

        def on_top(paths: dict[tuple[str, str], tuple[str, ...]]) -> dict[tuple[str, str], tuple[str, ...]]:
            rest = {key: path for key, path in paths.items() if key not in replaced}
            return rest | {key: rest.get(key, ()) + path if key in beside else path for key, path in written.items()}

        after = on_top(base.paths)
        try:
            kept, read, made = self._follow(after, replaced | written.keys(), base.kept, buckets)
        except Exception:
            self._remove(_folders(written))
            raise
        replaced, written = replaced | kept, written | made
        read -= replaced | written.keys()
        entry = {}
        if others is not None:
            entry[uuid.uuid4().hex] = folder = self._folder(OUTBOX)
            others.write.options(**PACKED).parquet(folder)
        while True:
            paths = on_top(base.paths)
            merged = self._merge_growing(paths)
            marks = base.marks | dict([mark] if mark else [])
            try:
                return self._commit(Commit(base.number + 1, paths, buckets, marks, base.outbox | entry, base.kept))
            except CommitConflict:
                newest = self.newest()
                meets = newest.buckets != buckets or newest.kept != base.kept or (mark and newest.marks.get(mark[0]) != base.marks.get(mark[0])) or any(
                    base.paths.get(key) != newest.paths.get(key) for key in replaced | read | written.keys())
                # Folders of this commit alone: of the merged ones another may have made use by reading only.
                self._remove(merged)
                if not rebase or meets:
                    self._remove([*_folders(written), *entry.values()])
                    raise
                base = newest

    def deliver(self, take: Callable[[DataFrame], None]) -> int:
        """Give every entry of the outbox to ``take``, oldest first, and acknowledge it; the number of entries.

        If ``take`` raises, its entry stays and is given out again by the next call. Each entry is given at least once;
        twice if the program ends between the two steps, or if two of them deliver at the same time.
        """
        waiting = self.newest().outbox
        for entry, folder in waiting.items():
            take(self.spark.read.parquet(folder))
            self.acknowledge(entry)
        return len(waiting)

    def acknowledge(self, entry: str) -> None:
        """Publish the tables as they are without an entry of the outbox."""
        while entry in (newest := self.newest()).outbox:
            rest = {key: folder for key, folder in newest.outbox.items() if key != entry}
            try:
                self._commit(dataclasses.replace(newest, number=newest.number + 1, outbox=rest))
            except CommitConflict:
                continue

    def maintain(self, name: str) -> int:
        """Make a kept table of all there is and publish it; from then on every commit brings it up to date."""
        while name not in (commit := self.newest()).kept:
            buckets = self.buckets_of(commit)
            _, _, made = self._follow(commit.paths, set(commit.paths), (name,), buckets)
            try:
                self._commit(dataclasses.replace(commit, number=commit.number + 1, paths=commit.paths | made, buckets=buckets,
                                                 kept=(*commit.kept, name)))
            except CommitConflict:
                self._remove(_folders(made))
        return commit.number

    def _follow(self, after: dict[tuple[str, str], tuple[str, ...]], changed: set[tuple[str, str]], names: Iterable[str],
                buckets: dict[str, int]) -> tuple[set[tuple[str, str]], set[tuple[str, str]], dict[tuple[str, str], tuple[str, ...]]]:
        """The parts of kept tables that follow from ``changed`` parts, where ``after`` are the folders of all parts then: all of
        them, the parts they were made of, and the folders of those that have rows. If this fails nothing of it is left."""
        keys, read, made = set(), set(), {}
        try:
            for name in names:
                rule = RULES[name]
                parts = {own for source, part in changed if source == rule.source for own in rule.follow(part)}
                keys |= {(name, own) for own in parts}
                # A part has rows where the one of the same name has some.
                here = sorted(own for own in parts if (rule.source, own) in after)
                if here:
                    needed = {part for own in here for part in rule.needs(own)}
                    read |= {(rule.source, part) for part in needed}
                    rows = self.read(rule.source, needed, Commit(paths=after)).withColumn("part", self.part_of(rule.source, buckets))
                    made |= self._write_parts(name, rule.make(rows).filter(F.col("part").isin(here)), buckets, F.col("part"))
        except Exception:
            self._remove(_folders(made))
            raise
        return keys, read, made

    def rebucket(self, name: str, buckets: int) -> int:
        """Publish a table again in another number of parts, and the kept tables that follow from it."""
        commit = self.newest()
        changed = commit.buckets | {name: buckets}
        following = [kept for kept in commit.kept if RULES[kept].source == name]
        paths = {key: path for key, path in commit.paths.items() if key[0] not in (name, *following)}
        written = self._write_parts(name, self.read(name, commit=commit), changed)
        written |= self._follow(paths | written, set(written), following, changed)[2]
        self.asked = None
        try:
            return self._commit(dataclasses.replace(commit, number=commit.number + 1, paths=paths | written, buckets=changed))
        except CommitConflict:
            self._remove(_folders(written))
            raise

    def _folder(self, name: str) -> str:
        return f"{self.root}/{name}/{uuid.uuid4().hex}"

    def _write_all(self, changes: dict[str, tuple[DataFrame, list[str]]], buckets: dict[str, int]) -> dict[tuple[str, str], tuple[str, ...]]:
        """The tables are written beside each other; if one fails, what the others have written is removed."""
        def write(name: str, rows: DataFrame) -> dict[tuple[str, str], tuple[str, ...]]:
            if name in GROWING:
                return {(name, f"0-{uuid.uuid4().hex}"): (self._write(name, rows),)}
            return self._write_parts(name, rows, buckets)

        if not changes:
            return {}
        with lean(self.spark), ThreadPoolExecutor(len(changes)) as pool:
            running = [pool.submit(inheritable_thread_target(self.spark)(write), name, rows) for name, (rows, _) in changes.items()]
        written = [f.result() for f in running if not f.exception()]
        for failed in running:
            if failed.exception():
                self._remove(folder for each in written for folder in _folders(each))
                raise failed.exception()
        return {key: path for each in written for key, path in each.items()}

    def _write(self, name: str, rows: DataFrame) -> str:
        target = self._folder(name)
        with lean(self.spark):
            rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name]]).write.options(**PACKED).parquet(target)
        return target

    def _write_parts(self, name: str, rows: DataFrame, buckets: dict[str, int], part: Column | None = None) -> dict[tuple[str, str], tuple[str, ...]]:
        target = self._folder(name)
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name]]
        # Rebalancing gives a part one file, or several where it is large.
        if part is None:
            parted = rows.select(typed).withColumn("part", self.part_of(name, buckets)).hint("rebalance", "part")
        else:
            parted = rows.select(*typed, part.alias("part")).hint("rebalance", "part")
        with lean(self.spark):
            parted.write.options(**PACKED).partitionBy("part").parquet(target)
        folders = (f.getPath().getName() for f in self._fs.listStatus(self._hadoop.Path(target)) if f.isDirectory())
        return {(name, part): (f"{target}/part={part}",) for part in (x.removeprefix("part=") for x in folders if x.startswith("part="))}

    def _merge_growing(self, paths: dict[tuple[str, str], tuple[str, ...]]) -> list[str]:
        """Folders of the growing tables by level; a level of ``LOG_FOLDERS`` becomes one folder of the next, so each row is
        rewritten a few times in all and the number of folders grows with the logarithm of the commits. The new folders."""
        made = []
        for name in GROWING:
            level = 0
            while any(key[0] == name and int(key[1].split("-")[0]) >= level for key in paths):
                full = sorted(key for key in paths if key[0] == name and key[1].startswith(f"{level}-"))
                if len(full) >= LOG_FOLDERS:
                    rows = self.spark.read.schema(TABLES[name]).parquet(*[folder for key in full for folder in paths.pop(key)])
                    made.append(self._write(name, rows.hint("rebalance")))
                    paths[name, f"{level + 1}-{uuid.uuid4().hex}"] = (made[-1],)
                level += 1
        return made

    def _commit(self, commit: Commit) -> int:
        """Make the commit visible under its number, or raise if the number is taken."""
        path = self._hadoop.Path
        draft = path(f"{self.root}/manifests/draft-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(commit.to_text().encode())
        finally:
            stream.close()
        manifest = path(self._manifest(commit.number))
        try:
            self._appear(self._fs.makeQualified(draft), self._fs.makeQualified(manifest))
        except Exception as error:
            self._fs.delete(draft, False)
            if not self._fs.exists(manifest):
                raise
            raise CommitConflict(f"commit {commit.number} is taken") from error
        self.expire()
        return commit.number

    def _appear(self, draft, manifest) -> None:
        """Give the draft its name in one step that fails if there is such a file."""
        if self._fs.getUri().getScheme() == "file":
            of = self.spark._jvm.java.nio.file.Paths.get
            self.spark._jvm.java.nio.file.Files.createLink(of(manifest.toUri()), of(draft.toUri()))
            self._fs.delete(draft, False)
            return
        files = self._hadoop.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        files.rename(draft, manifest, self.spark.sparkContext._gateway.new_array(self._hadoop.Options.Rename, 0))

    def expire(self) -> bool:
        """Remove all commits but the newest ``keep``, and the folders that only they name. Whether that was done: a commit does
        not fail by it, and what is left behind, as when another writer removes the same, goes with the next one."""
        try:
            numbers = self.numbers()
            gone, kept = numbers[: -self.keep], numbers[-self.keep:]
            used = set().union(*(self.at(number).folders() for number in kept)) if gone else set()
            for number in gone:
                self._remove(self.at(number).folders() - used, used)
                self._fs.delete(self._hadoop.Path(self._manifest(number)), False)
        except Exception:  # noqa: BLE001
            return False
        return True

    def _remove(self, folders: Iterable[str], used: Iterable[str] = ()) -> None:
        """Delete folders of data, and the folder of a write when none of its parts is in use."""
        folders = list(folders)
        alive = {path.rsplit("/part=", 1)[0] for path in used}
        for folder in {*folders, *({path.rsplit("/part=", 1)[0] for path in folders} - alive)}:
            self._fs.delete(self._hadoop.Path(folder), True)

    def _manifest(self, number: int) -> str:
        return f"{self.root}/manifests/{number:012d}.json"
