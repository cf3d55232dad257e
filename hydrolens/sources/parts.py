"""Tables whose dates are replaced one by one and switched together.

A set of tables has versions. A version is a list of folders: for each table and date the folders that
hold its rows, written by this version or carried over from an earlier one. So a date that nothing has
touched is neither read nor written again, and a reader sees all tables of a version or none: the
list is one file, which appears by a rename when every folder is complete.

The list names a table, date and version per folder, with the number of rows. Its size follows the number of
dates, not of rows. Counting a table reads no data.
"""

from __future__ import annotations

import datetime as dt
import math
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydrolens.sources.files import names_in, numbered, read_folders, read_json, remove, write_json

KEPT_VERSIONS = 2
# So many folders of one date and about one size are merged into one.
MERGED = 16
# Dates whose folders one task may write one after the other.
TASK_DATES = 32


@dataclass(frozen=True)
class Folder:
    """A folder of one table: its date (None if undated), the version that wrote it, its rows."""

    item: str
    part: dt.date | None
    version: int
    n: int


@dataclass
class Staged:
    """Folders that a version in the making has written, and the ones they stand for."""

    version: int
    folders: list[Folder] = field(default_factory=list)
    replaced: set[Folder] = field(default_factory=set)


@dataclass
class Version:
    """A complete version: its folders and what was noted when it was completed."""

    number: int
    folders: list[Folder]
    notes: dict

    def of(self, item: str, dates: set | None = None) -> list[Folder]:
        """The folders of a table, of all dates or of some."""
        return [f for f in self.folders if f.item == item and (dates is None or f.part in dates)]

    def rows(self, item: str) -> int:
        return sum(f.n for f in self.of(item))


class Parts:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._known: dict[int, Version] = {}

    def versions(self) -> list[int]:
        """The complete versions that are still there, oldest first."""
        return numbered(self.spark, f"{self.root}/complete")

    def version(self, number: int) -> Version:
        """A complete version. It never changes."""
        if number not in self._known:
            stored = read_json(self.spark, f"{self.root}/complete/{number}.json")
            folders = [Folder(i, p and dt.date.fromisoformat(p), v, n) for i, p, v, n in stored["folders"]]
            self._known[number] = Version(number, folders, stored["notes"])
        return self._known[number]

    def newest(self) -> Version:
        """The newest complete version; number 0, without folders, before the first."""
        numbers = self.versions()
        return self.version(numbers[-1]) if numbers else Version(0, [], {})

    def path(self, folder: Folder) -> str:
        path = f"{self.root}/{folder.item}/version={folder.version}"
        return path if folder.part is None else f"{path}/part={folder.part}"

    def read(self, folders: Iterable[Folder], schema: T.StructType) -> DataFrame:
        return read_folders(self.spark, [self.path(f) for f in folders if f.n], schema)

    def stage(self, staged: Staged, item: str, df: DataFrame, replaces: Iterable[Folder], date: str | None = None, dates: int = 0) -> None:
        """Writes rows for the version in the making, in place of some folders of the same table.

        date: the table's date column, None if it is kept as a whole. dates: how many it has, about.
        """
        path = f"{self.root}/{item}/version={staged.version}"
        if date is None:
            df.write.mode("overwrite").parquet(path)
            folders = [Folder(item, None, staged.version, self.spark.read.schema(df.schema).parquet(path).count())]
        else:
            dated = df.withColumn("part", F.col(date))
            writer = self._gathered(dated, dates).write.mode("overwrite")
            writer.option("partitionOverwriteMode", "static").partitionBy("part").parquet(path)
            counted = self.spark.read.schema(dated.schema).parquet(path).groupBy("part").count()
            folders = [Folder(item, r.part, staged.version, r["count"]) for r in counted.collect()]
        staged.folders += folders
        staged.replaced |= set(replaces)

    def _gathered(self, dated: DataFrame, dates: int) -> DataFrame:
        """Rows of a date are gathered, so a date is not written as one file per task. A date that is larger than
        the advisory size is split. Many small dates would come to one task, which opens their files one after
        the other: they are cut into ranges, which split a large date as well."""
        if dates <= TASK_DATES:
            return dated.hint("rebalance", "part")
        tasks = min(math.ceil(dates / TASK_DATES), int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        rest = F.xxhash64(*[c for c in dated.columns if c != "part"])
        return dated.repartitionByRange(tasks, "part", rest)

    def commit(self, staged: Staged, **notes: object) -> Version:
        """Makes the version the newest: what it has written, and all that it has not replaced."""
        carried = [f for f in self.newest().folders if f not in staged.replaced]
        folders = sorted([*carried, *staged.folders], key=lambda f: (f.item, str(f.part), f.version))
        listed = [(f.item, f.part and str(f.part), f.version, f.n) for f in folders]
        write_json(self.spark, f"{self.root}/complete/{staged.version}.json", {"notes": notes, "folders": listed})
        self._known[staged.version] = Version(staged.version, folders, notes)
        return self._known[staged.version]

    def clean(self, oldest: int | None = None) -> None:
        """Removes versions before the last `KEPT_VERSIONS` and before `oldest`, and the folders that no version left
        names, those of a version that was never completed included."""
        numbers = self.versions()
        if not numbers:
            return
        first = min(numbers[-KEPT_VERSIONS:][0], numbers[-1] if oldest is None else oldest)
        named = defaultdict(set)
        for number in numbers:
            if number >= first:
                for f in self.version(number).folders:
                    named[f.item, f.version].add(f.part)
            else:
                remove(self.spark, f"{self.root}/complete/{number}.json")
                self._known.pop(number, None)
        for item in set(names_in(self.spark, self.root)) - {"complete"}:
            for name in names_in(self.spark, f"{self.root}/{item}"):
                version = int(name.partition("=")[2])
                dates = named.get((item, version), set())
                if version > numbers[-1] or None in dates:
                    continue
                if not dates:
                    remove(self.spark, f"{self.root}/{item}/{name}")
                    continue
                for part in names_in(self.spark, f"{self.root}/{item}/{name}"):
                    if "=" in part and dt.date.fromisoformat(part.partition("=")[2]) not in dates:
                        remove(self.spark, f"{self.root}/{item}/{name}/{part}")


def crowded(folders: Iterable[Folder]) -> list[Folder]:
    """Folders to be merged: of each date those of about the same size (a power of `MERGED`), if there are
    `MERGED` of them. So a row is written again as often as its date has such powers."""
    alike = defaultdict(list)
    for f in folders:
        alike[f.part, int(math.log(max(f.n, 1), MERGED))].append(f)
    return [f for same in alike.values() if len(same) >= MERGED for f in same]


class Dimension:
    """A reference table that is reloaded as a whole; readers see the old rows until the new ones are complete."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.parts, self.schema = Parts(spark, root), schema

    def reload(self, df: DataFrame) -> DataFrame:
        before = self.parts.newest()
        staged = Staged(before.number + 1)
        self.parts.stage(staged, "rows", df.select(self.schema.names), before.folders)
        self.parts.commit(staged)
        self.parts.clean()
        return self.read()

    def read(self) -> DataFrame:
        return self.parts.read(self.parts.newest().folders, self.schema)

    def count(self) -> int:
        return self.parts.newest().rows("rows")
