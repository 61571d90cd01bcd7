"""Readings of archived pages, kept by the digest of the markup, so that an archive that is read again parses only what changed."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.extraction import EXTRACTED, NO_MARKUP, PROFILES, extract_pages
from ..sources.scratch import PACKED, drop_folder, lean, scratch_folder

#: Goes up with every change of what is read from a page; readings of another number are not used.
READER = 1

#: So many new pages are at most left to Spark's size checks; more are told by a sieve, so that no markup is shuffled.
FEW_PAGES = 50_000

#: Bits of a sieve for each key, and at most (32 MB). One row in so many that are none of the keys passes, more beyond that.
KEY_BITS = 64
MOST_BITS = 1 << 28

READING = T.StructType([T.StructField("digest", T.StringType()), *(f for f in EXTRACTED if f.name not in ("page_id", "url"))])
#: A folder of readings names the pages that they were read from, for the job that has written it.
OWNED = T.StructType([*READING, *(f for f in EXTRACTED if f.name in ("page_id", "url"))])


class StoredReadings:
    """What the pages of one ``profile`` say, under ``root`` as Parquet: one reading per different markup.

    A reading depends on the markup alone, so pages that share it, on whatever day or address, share its reading. Rows are only
    added; each ``add`` that finds something new writes a folder of its own. Writers beside each other may add the same reading;
    readers take one of them, which is as good as the other. Every row stands for itself, so a part of a folder does no harm.
    """

    def __init__(self, spark: SparkSession, root: str, profile: str = "classroom"):
        if profile not in PROFILES:
            raise ValueError(f"unknown profile {profile!r}, expected one of {PROFILES}")
        self.spark, self.profile = spark, profile
        self.path = f"{root.rstrip('/')}/reader={READER}/profile={profile}"

    def read(self) -> DataFrame:
        """The stored readings as they were added."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], READING)
        return self.spark.read.schema(READING).option("recursiveFileLookup", True).parquet(self.path)

    def add(self, pages: DataFrame) -> None:
        """Parse and store the markup of ``pages`` (page_id, url, html) that is not stored yet.

        Only ids and digests look for what is new, and no markup is shuffled: all pages are read where all are new, a few new ones
        are sent to the tasks, and of many the sieve lets a few known pages pass, which are then sent.
        """
        folder = scratch_folder(self.spark, "new-pages")
        try:
            self._add(pages, folder)
        finally:
            drop_folder(self.spark, folder)

    def _add(self, pages: DataFrame, folder: str) -> tuple[DataFrame, DataFrame | None]:
        """``add``; the rows that were parsed with what they say, if any, and page_id and digest of the other pages with markup, as
        written to ``folder``."""
        marked = pages.filter("html IS NOT NULL").select("page_id", "url", _digest().alias("digest"), "html")
        seen = self._written(marked.select("page_id", "digest"), f"{folder}/seen")
        # Of pages that share a markup the one of the smallest id is parsed.
        new = seen.join(self.read().select("digest"), "digest", "left_anti").groupBy("digest").agg(F.min("page_id").alias("page_id"))
        new = self._written(new, f"{folder}/new")
        count = new.count()
        if not count:
            return seen, None
        fresh = marked if count == seen.count() else self._fresh(marked, seen, new, count, folder)
        # The digest goes through the parser before the address.
        address = F.concat("digest", F.when(F.col("url").isNotNull(), F.concat(F.lit("+"), "url")).otherwise(F.lit("")))
        read = extract_pages(fresh.select("page_id", address.alias("url"), "html"), self.profile).withColumns({
            "digest": F.substring("url", 1, 64), "url": F.when(F.substring("url", 65, 1) == "+", F.expr("substring(url, 66)"))})
        owned = self._written(read.select(*OWNED.fieldNames()), f"{self.path}/{uuid.uuid4().hex}")
        return self._written(seen.join(new.hint("shuffle_hash"), _same(seen, new), "left_anti"), f"{folder}/others"), owned

    def _fresh(self, marked: DataFrame, seen: DataFrame, new: DataFrame, count: int, folder: str) -> DataFrame:
        """The rows of ``marked`` that are in ``new``."""
        if count <= FEW_PAGES:
            return marked.join(new, _same(marked, new), "left_semi")
        sieve, bits = self._sieve(new, ["digest", "page_id"], count, f"{folder}/sieve")
        passed = _pass(seen, sieve, ["digest", "page_id"], bits)
        known = self._written(passed.join(new, _same(passed, new), "left_anti").distinct(), f"{folder}/known")
        if known.count() > FEW_PAGES:
            known = known.hint("shuffle_hash")
        fresh = _pass(marked, sieve, ["digest", "page_id"], bits)
        return fresh.join(known, _same(fresh, known), "left_anti")

    def extract(self, pages: DataFrame, fields: Sequence[str] | None = None, made: dict[str, Column] | None = None) -> DataFrame:
        """What ``extract_pages`` gives for ``pages``; markup that is not stored yet is parsed and stored before.

        ``made``: more columns, of the fields of a reading alone. They are made before readings meet pages, so what they are made
        of moves only if it is among ``fields``, too.
        """
        made = made or {}
        folder = scratch_folder(self.spark, "new-pages")
        try:
            others, owned = self._add(pages, folder)
            stored, n_others = self.read(), others.count()
            n_stored = stored.count()
            # Readings that none of the other pages has do not move if they are more than a few.
            if 8 * (n_stored - n_others) > n_stored:
                sieve, bits = self._sieve(others, ["digest"], n_others, scratch_folder(self.spark, "sieve"))
                stored = _pass(stored, sieve, ["digest"], bits)
        finally:
            drop_folder(self.spark, folder)
        sent = [f.name for f in EXTRACTED if f.name == "page_id" or fields is None or f.name in fields]
        kept = [c for c in READING.fieldNames() if c in sent or c == "rejected"]
        one = stored.select("digest", F.struct(*kept, *[column.alias(c) for c, column in made.items()]).alias("reading"))
        # Only writers beside each other store a digest again; the readings are sorted for them alone.
        with lean(self.spark):
            once = stored.groupBy("digest").count().filter("count > 1").isEmpty()
        if not once:
            one = one.groupBy("digest").agg(F.any_value("reading").alias("reading"))
        every = pages.select("page_id", "url", _digest().alias("digest"))
        if owned is not None:  # what was just read has its page beside it
            own = owned.select("digest", "page_id").hint("shuffle_hash")
            every = every.join(own, _same(every, own), "left_anti")
        # Ids and digests are hashed and the readings pass by, as they are much larger.
        every = every.hint("shuffle_hash").join(one, "digest", "left")
        rejected = F.when(F.col("digest").isNull(), F.lit(NO_MARKUP)).otherwise(F.col("reading.rejected"))
        columns = {"page_id": F.col("page_id"), "url": F.col("url"), "rejected": rejected}
        found = every.select(*[columns.get(c, F.col(f"reading.{c}")).alias(c) for c in sent], *[F.col(f"reading.{c}").alias(c) for c in made])
        if owned is None:
            return found
        return owned.select(*sent, *[column.alias(c) for c, column in made.items()]).unionByName(found)

    def _written(self, rows: DataFrame, path: str) -> DataFrame:
        with lean(rows.sparkSession):
            rows.write.options(**PACKED).parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _sieve(self, keys: DataFrame, columns: list[str], count: int, path: str) -> tuple[DataFrame, int]:
        """A bit for the hash of every key, in rows of 4 KB, and how many bits there are: as ``_pass`` takes them."""
        bits = min(MOST_BITS, 1 << max(15, (KEY_BITS * count).bit_length()))
        spot = _spot(columns, bits)
        spots = keys.select(F.bitmap_bucket_number(spot).alias("sieve_row"), F.bitmap_bit_position(spot).alias("bit"))
        rows = spots.repartition("sieve_row").groupBy("sieve_row").agg(F.bitmap_construct_agg("bit").alias("sieve_bits"))
        return self._written(rows, path), bits


def _spot(columns: list[str], bits: int) -> Column:
    """Number of a key's bit, from 1 on as Spark's bitmap functions count."""
    return F.pmod(F.xxhash64(*columns), F.lit(bits)) + 1


def _pass(rows: DataFrame, sieve: DataFrame, columns: list[str], bits: int) -> DataFrame:
    """The rows whose key is in the sieve, and a few others. The sieve is small by its making, so it is sent to the tasks."""
    spot = _spot(columns, bits)
    bit = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.substring("sieve_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return rows.join(F.broadcast(sieve), F.bitmap_bucket_number(spot) == F.col("sieve_row")).filter(
        F.getbit(byte, (bit % 8).cast("int")) == 1).select(*rows.columns)


def _same(a: DataFrame, b: DataFrame) -> Column:
    return (a["digest"] == b["digest"]) & a["page_id"].eqNullSafe(b["page_id"])


def _digest() -> Column:
    return F.sha2("html", 256)
