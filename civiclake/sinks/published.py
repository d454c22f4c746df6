"""Publishing a table as a whole, or some of its partitions, with a commit record.

New files are first written to a hidden folder inside the table
(``_novo/<id>``); readers skip names that begin with ``_``.  Once all of
them are there, one small file, the commit record ``_publicacao.json``,
names what moves in and what goes.  From then on the new version is the
table: the moves that follow only tidy up, and can be repeated after a
crash at any point (``recover``).  Before the record exists nothing that a
reader sees has changed, so a frame may read the table it replaces, and a
lost driver leaves either the old version or the new one.

``read_published`` shows a whole version at every moment: while a record
waits it reads what moves from the hidden folder.  A plain
``spark.read.parquet(path)`` sees the same files once the moves are done.
One writer at a time.

Every publication leaves a record in ``_versoes/<n>.json``: its number, the
run that made it, the schema, and the rows of each partition, so row counts
of tables need no scan and an empty table keeps its columns.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civiclake.sinks.writers import _observed_rows, arranged

NEW, RECORD, VERSIONS = "_novo", "_publicacao.json", "_versoes"
NULL_PART = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class Version:
    """One publication; ``rows`` by partition folder (the whole table under ''); ``schema`` as JSON."""

    number: int
    id: str
    run: str
    move: list[str] = field(default_factory=list)
    remove: list[str] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)
    schema: str = ""

    @property
    def total(self) -> int:
        return sum(self.rows.values())


class Folder:
    """Names, small files and renames under a path of any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.fs = self._at("").getFileSystem(self.conf)

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._at(name))) if self.exists(name) else []

    def visible(self, name: str = "") -> list[str]:
        return [n for n in self.names(name) if not n.startswith(("_", "."))]

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)

    def rename(self, old: str, new: str) -> None:
        target = self._at(new)
        self.fs.mkdirs(target.getParent())
        if not self.fs.rename(self._at(old), target):
            raise OSError(f"{self.path}: {old} could not become {new}")

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """A file appears under its name with all its content or not at all."""
        part = f"{name}.{uuid.uuid4().hex}.tmp".replace("/", "/_")
        out = self.fs.create(self._at(part), False)
        try:
            out.write(text.encode())
        finally:
            out.close()
        self.rename(part, name)


def part_name(column: str, value) -> str:
    return f"{column}={NULL_PART if value is None else value}"


def _pending(folder: Folder) -> Version | None:
    return Version(**json.loads(folder.read(RECORD))) if folder.exists(RECORD) else None


def is_published(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at the path."""
    folder = Folder(spark, path)
    return folder.exists(RECORD) or folder.exists(VERSIONS) or bool(folder.visible())


def versions(spark: SparkSession, path: str) -> list[Version]:
    """Publications of a table, oldest first."""
    folder = Folder(spark, path)
    return [Version(**json.loads(folder.read(f"{VERSIONS}/{n}"))) for n in folder.visible(VERSIONS)]


def latest_version(spark: SparkSession, path: str) -> Version | None:
    """The last settled publication of a table."""
    folder = Folder(spark, path)
    names = folder.visible(VERSIONS)
    return Version(**json.loads(folder.read(f"{VERSIONS}/{names[-1]}"))) if names else None


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a publication whose record waits, and clear what one without a record left; true if there was a record."""
    folder = Folder(spark, path)
    waiting = _pending(folder)
    if waiting:
        _settle(folder, waiting)
    for name in folder.names(NEW):
        folder.delete(f"{NEW}/{name}")
    return waiting is not None


def _settle(folder: Folder, version: Version) -> None:
    """The moves of a record; each step may be repeated."""
    for name in version.remove:
        folder.delete(name)
    for name in version.move:
        if folder.exists(f"{NEW}/{version.id}/{name}"):  # else it has moved already
            folder.delete(name)
            folder.rename(f"{NEW}/{version.id}/{name}", name)
    # the latest record has the rows of all partitions
    folder.delete(f"{VERSIONS}/{version.number:09d}.json")
    folder.write(f"{VERSIONS}/{version.number:09d}.json", json.dumps(asdict(version)))
    folder.delete(RECORD)
    folder.delete(f"{NEW}/{version.id}")


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = (), parts: Iterable[str] | None = None, run: str = "",
            rebalance: bool = False) -> Version:
    """Publish ``df`` as the table at ``path``, or as its partitions ``parts`` (folder names of the
    first partition column; those without rows go, others stay as they are).  ``rebalance`` as in
    :func:`civiclake.sinks.writers.arranged`."""
    spark = df.sparkSession
    recover(spark, path)
    folder = Folder(spark, path)
    before = latest_version(spark, path)
    new = Version(before.number + 1 if before else 1, uuid.uuid4().hex, run, schema=df.schema.json())
    staged = f"{path.rstrip('/')}/{NEW}/{new.id}"
    obs = Observation("rows")
    out = arranged(df, partition_by, rebalance).observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = out.write.partitionBy(*partition_by) if partition_by else out.write
    writer.mode("errorifexists").parquet(staged)
    new.move = folder.visible(f"{NEW}/{new.id}")
    if parts is None:
        new.remove = [n for n in folder.visible() if n not in new.move]
    else:
        parts = list(parts)
        if extra := set(new.move) - set(parts):
            raise ValueError(f"rows outside the partitions to replace: {sorted(extra)}")
        new.remove = [n for n in parts if n not in new.move]
        new.rows = dict(before.rows) if before else {}
    if partition_by:
        # row counts of files just written come from their footers
        counts = spark.read.schema(df.schema).parquet(staged).groupBy(partition_by[0]).count().collect() if new.move else []
        new.rows = {p: n for p, n in new.rows.items() if p not in new.remove} | {part_name(partition_by[0], r[0]): r["count"] for r in counts}
    else:
        new.rows = {"": _observed_rows(obs, df)}
    folder.write(RECORD, json.dumps(asdict(new)))
    _settle(folder, new)
    return new


def read_published(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The current version of a table, also while a publication is being settled; a path without a table raises as any missing path."""
    folder = Folder(spark, path)
    waiting = _pending(folder)
    if schema is None:
        last = waiting or latest_version(spark, path)
        schema = StructType.fromJson(json.loads(last.schema)) if last and last.schema else None
    reader = spark.read if schema is None else spark.read.schema(schema)
    if waiting is None:
        return reader.parquet(path)
    root = path.rstrip("/")
    staged = [n for n in waiting.move if folder.exists(f"{NEW}/{waiting.id}/{n}")]
    settled = [n for n in folder.visible() if n not in waiting.remove and n not in staged]
    found = []
    for base, names in ((root, settled), (f"{root}/{NEW}/{waiting.id}", staged)):
        if names:
            found.append((spark.read if schema is None else spark.read.schema(schema)).option("basePath", base).parquet(*[f"{base}/{n}" for n in names]))
    if not found:
        return spark.createDataFrame([], schema) if schema is not None else reader.parquet(path)
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])
