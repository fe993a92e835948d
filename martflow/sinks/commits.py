"""Tables whose batches become visible by one file each.

A batch is written under a unique name, then a manifest with the batch's query and number
lists what it has written. Readers take what manifests list, so they see a batch whole
or not at all, and once, however often it was tried: a batch that has its manifest is not
written again. What a killed attempt leaves behind is never listed. ::

    data/commit=<unique>/<part>=<value>/*.parquet
    commits/<query>.<batch>.json     a line for each part that a batch has written
    merges/<number>.json             parts read together and written as one, and for which
    folds/<number>.json              the table after that many merges, all in one file

Rows are split by the column ``part``: a day, a topic, a bucket of keys. Merges work part
by part and by levels: ``fan_in`` segments of a level make one of the next, so a part
holds some for each level, however many batches there were, and a row is rewritten once
a level. A merge counts if all it replaces is still there, so of two that overlap one
counts. Replaced files stay for readers that hold them until ``clean`` finds them old.

Manifests not yet in a fold are read in the driver, small ones and ``fold_every`` at
most; a fold and a reader's list of files grow with the parts, not with the batches.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.schemas import LONG, TEXT, record
from martflow.sinks.files import Files

FAN_IN = 8
FOLD_EVERY = 32
# Set by Spark around each micro-batch.
_QUERY_ID = "sql.streaming.queryId"
_LINE = record(part=TEXT, path=TEXT, files=T.ArrayType(TEXT), bytes=LONG, level=LONG)


def query_name(spark: SparkSession, otherwise: str = "batch") -> str:
    """The streaming query whose micro-batch this is; its checkpoint keeps the name."""
    return spark.sparkContext.getLocalProperty(_QUERY_ID) or otherwise


@dataclass(frozen=True)
class Segment:
    """The files of one part that a batch or a merge has written."""

    part: str
    path: str
    files: tuple[str, ...]
    bytes: int
    level: int = 0


@dataclass
class _State:
    live: dict[str, Segment] = field(default_factory=dict)  # by path
    done: dict[str, int] = field(default_factory=dict)  # last batch of each query
    merges: int = 0
    loose: int = 0  # manifests that are in no fold


@dataclass(frozen=True)
class CommitTable:
    """A table in ``folder`` with the columns of ``schema``, split by its column ``part``."""

    folder: str
    schema: T.StructType
    part: str
    options: tuple[tuple[str, str], ...] = ()  # of the Parquet writer
    sort: tuple[str, ...] = ()  # order within files

    # --- writing

    def commit(self, rows: DataFrame, batch: int, query: str | None = None) -> bool:
        """Add a batch; False if it is there already, and nothing is written then."""
        spark = rows.sparkSession
        files = Files(spark, self.folder)
        query = query or query_name(spark)
        state = self._state(files)
        if batch <= state.done.get(query, -1):
            return False
        segments = self._write(files, rows, 0)
        files.put(f"commits/{query}.{batch:012d}.json", _lines(segments))
        return True

    def _write(self, files: Files, rows: DataFrame, level: int) -> list[Segment]:
        # Adaptive execution makes files of even size, also of a part with most rows.
        rows = rows.select(self.schema.names).hint("rebalance", self.part)
        if self.sort:
            rows = rows.sortWithinPartitions(self.part, *self.sort)
        path = f"data/commit={uuid.uuid4().hex}"
        writer = rows.write.partitionBy(self.part).options(**dict(self.options))
        files.make("commits")
        writer.parquet(f"{self.folder}/{path}")
        segments = []
        for found in files.listed(path):
            if found.is_folder:
                inner = files.listed(f"{path}/{found.name}")
                segments.append(
                    Segment(
                        unquote(found.name.split("=", 1)[1]),
                        f"{path}/{found.name}",
                        tuple(f.name for f in inner),
                        sum(f.size for f in inner),
                        level,
                    )
                )
        return segments

    def merge(
        self,
        spark: SparkSession,
        fold: Callable[[DataFrame], DataFrame] | None = None,
        fan_in: int = FAN_IN,
        whole: bool = False,
    ) -> int:
        """Merge parts that hold ``fan_in`` segments of a level; returns how many parts.

        ``fold`` makes the merged rows of the rows that are there. ``whole`` merges each
        part that holds two segments or more.
        """
        files = Files(spark, self.folder)
        state = self._state(files)
        groups: dict[tuple, list[Segment]] = {}
        for segment in state.live.values():
            groups.setdefault((segment.part, 0 if whole else segment.level), []).append(segment)
        least = 2 if whole else fan_in
        chosen = {key: own for key, own in groups.items() if len(own) >= least}
        if chosen:
            added = []
            for level in sorted({max(s.level for s in own) for own in chosen.values()}):
                own = [s for g in chosen.values() if max(s.level for s in g) == level for s in g]
                rows = self.of(spark, own)
                added += self._write(files, fold(rows) if fold else rows, level + 1)
            replaced = [s.path for own in chosen.values() for s in own]
            files.make("merges")
            told = json.dumps({"replaced": replaced, "added": [asdict(s) for s in added]})
            try:
                files.put(f"merges/{state.merges + 1:012d}.json", told)
            except FileExistsError:  # another merge came first
                return 0
        if state.loose >= FOLD_EVERY:
            self._fold(files)
        return len(chosen)

    def _fold(self, files: Files) -> None:
        state = self._state(files)
        files.make("folds")
        told = {"done": state.done, "merges": state.merges}
        told["live"] = [asdict(s) for s in state.live.values()]
        # Of two folds after one merge the one that knows more commits is the later.
        name = f"{state.merges:012d}.{sum(state.done.values()) + len(state.done):012d}"
        if not files.exists(f"folds/{name}.json"):
            files.put(f"folds/{name}.json", json.dumps(told))

    def clean(self, spark: SparkSession, older_than_s: float = 7 * 86_400) -> int:
        """Delete what no manifest lists, and manifests a fold holds, once they are old.

        Readers and streams that take longer to get to a file fail. Returns the number of
        deleted folders and files.
        """
        files = Files(spark, self.folder)
        before = int((time.time() - older_than_s) * 1000)
        state = self._state(files)
        used = {path.split("/")[1] for path in state.live}
        inside = set(state.live)
        gone = []
        for commit in files.listed("data"):
            path = f"data/{commit.name}"
            if commit.name not in used:
                if commit.modified <= before:
                    gone.append(path)
                continue
            for part in files.listed(path):
                if part.is_folder and f"{path}/{part.name}" not in inside:
                    # Replaced, and so long ago as the merge that did it.
                    if self._replaced_at(files, f"{path}/{part.name}") <= before:
                        gone.append(f"{path}/{part.name}")
        folds = files.listed("folds")
        if folds:
            told = json.loads(files.read(f"folds/{folds[-1].name}"))
            for found in files.listed("commits"):
                query, batch = _named(found.name)
                if batch <= told["done"].get(query, -1) and found.modified <= before:
                    gone.append(f"commits/{found.name}")
            for found in files.listed("merges"):
                if int(found.name.split(".")[0]) <= told["merges"] and found.modified <= before:
                    gone.append(f"merges/{found.name}")
            gone += [f"folds/{f.name}" for f in folds[:-1] if f.modified <= before]
        for name in gone:
            files.delete(name)
        return len(gone)

    def _replaced_at(self, files: Files, path: str) -> int:
        for found in files.listed("merges"):
            if path in json.loads(files.read_once(found, "merges"))["replaced"]:
                return found.modified
        return 0

    # --- reading

    def _state(self, files: Files) -> _State:
        state = _State()
        # Commits are listed before merges, so that what a merge replaces is known.
        commits, merges = files.listed("commits"), files.listed("merges")
        folds = files.listed("folds")
        if folds:
            told = json.loads(files.read_once(folds[-1], "folds"))
            state.done, state.merges = told["done"], told["merges"]
            state.live = {s.path: s for s in map(_segment, told["live"])}
        known = dict(state.done)
        for found in commits:
            query, batch = _named(found.name)
            if batch > known.get(query, -1):
                for line in files.read_once(found, "commits").splitlines():
                    segment = _segment(json.loads(line))
                    state.live[segment.path] = segment
                state.done[query] = max(batch, state.done.get(query, -1))
                state.loose += 1
        for found in merges:
            number = int(found.name.split(".")[0])
            if number <= state.merges:
                continue
            told = json.loads(files.read_once(found, "merges"))
            if all(path in state.live for path in told["replaced"]):
                for path in told["replaced"]:
                    del state.live[path]
                for segment in map(_segment, told["added"]):
                    state.live[segment.path] = segment
            state.merges = number
            state.loose += 1
        return state

    def segments(
        self, spark: SparkSession, parts: Iterable[str] | None = None
    ) -> list[Segment]:
        """What the table consists of now, of some parts or of all."""
        live = self._state(Files(spark, self.folder)).live.values()
        wanted = None if parts is None else set(parts)
        return [s for s in live if wanted is None or s.part in wanted]

    def of(self, spark: SparkSession, segments: list[Segment]) -> DataFrame:
        """The rows of some segments."""
        if not segments:
            return spark.createDataFrame([], self.schema)
        reader = spark.read.schema(self.schema).option("basePath", f"{self.folder}/data")
        found = reader.parquet(*[f"{self.folder}/{s.path}" for s in segments])
        return found.select(self.schema.names)

    def read(self, spark: SparkSession, parts: Iterable[str] | None = None) -> DataFrame:
        """The table as it is now; of some parts, their files alone are listed."""
        return self.of(spark, self.segments(spark, parts))

    def stream(
        self,
        spark: SparkSession,
        parts: Iterable[str] | None = None,
        batches: int | None = None,
    ) -> DataFrame:
        """The rows of each batch, once, as batches are committed.

        A manifest is what the stream's checkpoint remembers; a micro-batch takes
        ``batches`` of them, or all there are. Tasks read the files that it lists.
        """
        Files(spark, self.folder).make("commits")
        reader = spark.readStream.schema(_LINE)
        if batches:
            reader = reader.option("maxFilesPerTrigger", batches)
        listed = reader.json(f"{self.folder}/commits")
        if parts is not None:
            listed = listed.where(F.col("part").isin(list(parts)))
        named = listed.select("part", "path", F.explode("files").alias("file"))
        spread = named.repartition(spark.sparkContext.defaultParallelism, "path", "file")
        return spread.mapInArrow(_read_files(self.folder, self.schema, self.part), self.schema)


def _lines(segments: list[Segment]) -> str:
    return "".join(json.dumps(asdict(s)) + "\n" for s in segments)


def _segment(told: dict) -> Segment:
    segment = Segment(**told)
    return replace(segment, files=tuple(segment.files))


def _named(file: str) -> tuple[str, int]:
    """Query and batch of a manifest's name."""
    query, batch, _ = file.rsplit(".", 2)
    return query, int(batch)


def _read_files(folder: str, schema: T.StructType, part: str):
    """A function for ``mapInArrow``: the rows of the files that its rows name."""

    def read(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = to_arrow_schema(schema)
        uri = "://" in folder or folder.startswith("file:")
        store, base = fs.FileSystem.from_uri(folder) if uri else (fs.LocalFileSystem(), folder)
        for batch in batches:
            for row in batch.to_pylist():
                path = f"{base}/{row['path']}/{row['file']}"
                with store.open_input_file(path) as source:
                    for found in pq.ParquetFile(source).iter_batches(10_000):
                        value = None if row["part"] == _NULL_PART else row["part"]
                        columns = []
                        for named in wanted:
                            if named.name == part:
                                column = pa.array([value] * found.num_rows, pa.string())
                            else:
                                column = found.column(named.name)
                            columns.append(column.cast(named.type))
                        yield pa.RecordBatch.from_arrays(columns, schema=wanted)

    return read


# What Spark names the folder of a null.
_NULL_PART = "__HIVE_DEFAULT_PARTITION__"
