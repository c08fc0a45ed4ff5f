"""Delimited files as a stream that admits a number of records at a time.

An index of the files says where stretches of so many records begin and end. A small
Python source then admits as many stretches per micro-batch as make up the records of a
batch, its offset being a file's number and a row in it, so a restarted stream goes on in
mid-file. Only the stretches pass through the source: they are dealt over tasks, which read
their bytes, and Spark's parser takes the records apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from skyledger.schema import text_schema
from skyledger.session import send_code_with_tasks
from skyledger.sources.archives import CHUNK_BYTES, RecordEnds
from skyledger.sources.headers import CSV_OPTIONS, HEADER_BYTES, MissingColumnsError, header_names
from skyledger.sources.paths import file_system, spread_members
from skyledger.sources.tables import source_guard

send_code_with_tasks(__name__)

STRETCHES = "path string, header string, first_row bigint, rows bigint, start bigint, stop bigint"
SOURCE_NAME = "delimited_stretches"
#: Records of a stretch at most, and of a batch for each task that it is dealt to.
STRETCH_RECORDS, TASK_RECORDS = 50_000, 250_000


def _file_stretches(path: str, per_batch: int) -> Iterator[tuple]:
    """``header, first row, rows, start, stop`` of each stretch of a file, read in chunks.

    Blank lines are no records; a last record needs no line break.
    """
    system, inner = file_system(path)
    ends, header, head = RecordEnds(), None, b""
    place = begun = start = rows = first_row = 0

    def record(end: int) -> tuple | None:
        """Take notice of the record from ``begun`` to ``end``; a stretch that it completes."""
        nonlocal header, begun, start, rows, first_row
        size, begun = end - begun, end
        if header is None:
            header, start = head.decode("utf-8", "replace").rstrip("\r\n"), end
        elif size > 2 or head.strip(b"\r\n"):
            rows += 1
            if rows == per_batch:
                done = header, first_row, rows, start, end
                first_row, rows, start = first_row + rows, 0, end
                return done
        return None

    with system.open_input_stream(inner, compression=None) as stream:
        while chunk := stream.read(CHUNK_BYTES):
            at = 0
            for end in ends.of(chunk).tolist():
                # Of a record, only what tells a header or a blank line is kept.
                head += chunk[at : min(end, at + (HEADER_BYTES if header is None else 3))]
                if done := record(place + end):
                    yield done
                head, at = b"", end
            head += chunk[at : at + (HEADER_BYTES if header is None else 3)]
            place += len(chunk)
    if begun < place and (done := record(place)):
        yield done
    if rows:
        yield header, first_row, rows, start, place


def index_records(spark: SparkSession, path: str, index: str, per_batch: int) -> list[str]:
    """Index the files below ``path`` that ``index`` does not hold yet; the header's names.

    Each file gets a number and a folder in the index, new files after the old ones, so
    offsets stay valid when files are added. All files must have the same header.
    """
    with source_guard(path):
        files = spark.read.format("binaryFile").load(path).filter("length > 0").select("path")
        if not files.take(1):
            raise MissingColumnsError(f"{path} has no header")
    place = spark._jvm.org.apache.hadoop.fs.Path(index)
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    schema = f"{STRETCHES}, file int"
    known = spark.read.schema(schema).parquet(index) if system.exists(place) else spark.createDataFrame([], schema)
    last = known.agg(F.max("file")).first()[0]
    order = F.row_number().over(Window.orderBy("path")) + (-1 if last is None else last)
    new = files.join(known.select("path").distinct(), "path", "left_anti").select("path", order.cast("int").alias("file"))

    most = min(per_batch, STRETCH_RECORDS)

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["path", "header", "first_row", "rows", "start", "stop", "file"]
        for batch in batches:
            for found, number in zip(batch["path"], batch["file"]):
                rows = [(found, *stretch, number) for stretch in _file_stretches(found, most)]
                # A file without records keeps its number.
                yield pd.DataFrame(rows or [(found, None, 0, 0, 0, 0, number)], columns=names)

    rows = spread_members(new, "files-to-index").mapInPandas(stretches, schema)
    rows.write.mode("append").partitionBy("file").parquet(index)
    headers = spark.read.schema(schema).parquet(index).filter("rows > 0").select("header").distinct().limit(2).collect()
    if len(headers) > 1:
        raise MissingColumnsError(f"files below {path} have several headers")
    return header_names(headers[0].header) if headers else []


class StretchReader(SimpleDataSourceStreamReader):
    """Admits the next stretches of an index, of ``records`` records at most together or one
    stretch at least; its offset is a file's number and a row."""

    def __init__(self, index: str, records: int):
        self.index, self.records, self.held = index, records, (None, [])

    def initialOffset(self) -> dict:
        return {"file": 0, "row": 0}

    def _stretches(self, number: int) -> list[tuple]:
        """The stretches of one file; none if the index does not hold it."""
        if self.held[0] != number:
            import pyarrow.parquet as pq
            from pyarrow import fs

            system, inner = file_system(f"{self.index}/file={number}")
            if system.get_file_info(inner).type != fs.FileType.Directory:
                return []
            parts = [f.path for f in system.get_file_info(fs.FileSelector(inner)) if f.path.endswith(".parquet")]
            names = ["path", "first_row", "rows", "start", "stop"]
            rows = [r for p in parts for r in pq.read_table(p, columns=names, filesystem=system, partitioning=None).to_pylist()]
            self.held = (number, sorted(tuple(r[n] for n in names) for r in rows))
        return self.held[1]

    def _next(self, offset: dict) -> tuple[list[tuple], dict]:
        number, row = offset["file"], offset["row"]
        while found := self._stretches(number):
            for path, first_row, rows, start, stop in found:
                if first_row == row and rows:
                    return [(path, first_row, rows, start, stop)], {"file": number, "row": row + rows}
            number, row = number + 1, 0
        return [], offset

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        admitted, records, end = [], 0, start
        while True:
            found, after = self._next(end)
            records += sum(rows for _, _, rows, _, _ in found)
            if not found or (admitted and records > self.records):
                return iter(admitted), end
            admitted, end = admitted + found, after

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        while start != end:
            rows, start = self._next(start)
            if not rows:
                return
            yield from rows

    def commit(self, end: dict) -> None:
        """Nothing is to be done: the offset says all."""


class StretchSource(DataSource):
    """The stretches of the index named by the option ``index``, with at most as many records
    per micro-batch as the option ``records`` says."""

    @classmethod
    def name(cls) -> str:
        return SOURCE_NAME

    def schema(self) -> str:
        return "path string, first_row bigint, rows bigint, start bigint, stop bigint"

    def simpleStreamReader(self, schema) -> StretchReader:
        return StretchReader(self.options["index"], int(self.options["records"]))


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of the stretches as text, with file and row."""
    for batch in batches:
        for stretch in batch.to_pylist():
            system, inner = file_system(stretch["path"])
            with system.open_input_file(inner) as handle:
                handle.seek(stretch["start"])
                ends, rest, row, left = RecordEnds(), b"", stretch["first_row"], stretch["stop"] - stretch["start"]
                while left:
                    chunk = handle.read(min(CHUNK_BYTES, left))
                    if not chunk:
                        raise EOFError(f"{stretch['path']} has become shorter")
                    left -= len(chunk)
                    cuts = (ends.of(chunk) + len(rest)).tolist()
                    data = rest + chunk
                    if not left and (not cuts or cuts[-1] < len(data)):
                        cuts.append(len(data))
                    lines = [data[a:b].rstrip(b"\r\n") for a, b in zip([0, *cuts], cuts)]
                    lines = [line.decode("utf-8", "replace") for line in lines if line]
                    rest = data[cuts[-1] :] if cuts else data
                    if lines:
                        rows = pa.array(range(row, row + len(lines)), pa.int64())
                        paths = pa.repeat(pa.scalar(stretch["path"]), len(lines))
                        yield pa.RecordBatch.from_arrays([paths, rows, pa.array(lines)], ["path", "row", "value"])
                        row += len(lines)


def record_stream(
    spark: SparkSession, path: str, index: str, per_batch: int, record_id: str | None = "record_id"
) -> DataFrame:
    """Stream the records of the files below ``path``, ``per_batch`` of them at a time, at
    most: a batch is made up of whole stretches, of one file or several, and a file's last
    stretch is shorter. A large batch is dealt over tasks stretch by stretch.

    All values are text, blank ones ``''``. ``record_id`` names a further column with the
    record's file and row, by which a consumer knows a record that is sent again.
    """
    if per_batch < 1:
        raise ValueError("a batch must admit at least one record")
    names = index_records(spark, path, index, per_batch)
    spark.dataSource.register(StretchSource)
    stretches = spark.readStream.format(SOURCE_NAME).option("index", index).option("records", per_batch).load()
    tasks = min(spark.sparkContext.defaultParallelism, -(-per_batch // TASK_RECORDS))
    if tasks > 1:
        stretches = stretches.repartition(tasks)
    records = stretches.mapInArrow(_records, "path string, row bigint, value string")
    parsed = F.from_csv("value", F.lit(text_schema([f"_{i}" for i in range(len(names))]).simpleString()[7:-1].replace(":", " ")), CSV_OPTIONS)
    values = [F.coalesce(F.col(f"data._{i}"), F.lit("")).alias(name) for i, name in enumerate(names)]
    if record_id is not None:
        values.append(F.concat_ws(":", "path", "row").alias(record_id))
    return records.withColumn("data", parsed).select(*values)
