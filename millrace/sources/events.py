"""The event stream as a table of Parquet files.

    <stream>/data/<writer>/<batch>/       the events of one append
    <stream>/positions/<writer>/<batch>/  one row per segment it touched, written after the data

An append counts once its positions are there. Readers go by positions, so they never see half an append, and may skip
whole appends that lie outside the wanted range.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.render import utf8_text

EVENT_SCHEMA = "segment int, offset bigint, routing_key string, event binary, append_ts timestamp"
POSITION_SCHEMA = "writer string, batch bigint, segment int, head bigint, tail bigint, next_offset bigint"
UNBOUNDED = "UNBOUNDED"

Cut = Mapping[int, int]


def data_folder(path: str) -> str:
    return f"{path.rstrip('/')}/data"


def positions_folder(path: str) -> str:
    return f"{path.rstrip('/')}/positions"


def append_name(writer: str, batch: int) -> str:
    """The folder of one append. Padded, so that folders list in order where files carry coarse times."""
    return f"{writer}/{batch:012d}"


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, for any scheme the cluster knows."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = hadoop_path(spark, path)
    return files.exists(target)


def create_stream(spark: SparkSession, path: str) -> None:
    """Create an empty stream; an existing one stays as it is."""
    for folder in (data_folder(path), positions_folder(path)):
        files, target = hadoop_path(spark, folder)
        files.mkdirs(target)


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.schema(POSITION_SCHEMA).option("recursiveFileLookup", "true")
    return reader.parquet(positions_folder(path))


def stream_info(events: DataFrame) -> DataFrame:
    """Head and tail of every segment, computed from the events themselves."""
    return events.groupBy("segment").agg(F.min("offset").alias("head"), (F.max("offset") + 1).alias("tail"))


def stream_ends(spark: SparkSession, path: str) -> dict[int, tuple[int, int]]:
    """Head and tail per segment from the positions alone; one entry per segment, however long the stream."""
    ends = read_positions(spark, path).where("segment is not null").groupBy("segment")
    rows = ends.agg(F.min("head").alias("head"), F.max("tail").alias("tail")).collect()
    return {row.segment: (row.head, row.tail) for row in rows}


def parse_cut(text: str | None) -> Cut | None:
    """A cut such as `{"0": 120, "1": 80}`; None for no bound."""
    if text is None or not text.strip() or text.strip() == UNBOUNDED:
        return None
    return {int(segment): int(offset) for segment, offset in json.loads(text).items()}


def cut_text(cut: Cut | None) -> str:
    return UNBOUNDED if cut is None else json.dumps({str(segment): offset for segment, offset in sorted(cut.items())})


def tail_cut(spark: SparkSession, path: str) -> Cut:
    return {segment: tail for segment, (_, tail) in stream_ends(spark, path).items()}


def resolve_start(spark: SparkSession, path: str, at_tail: bool = False, cut: Cut | None = None) -> Cut | None:
    """The tail as of now if asked for, else the given cut, else the head."""
    if at_tail:
        return tail_cut(spark, path)
    return cut


def resolve_end(spark: SparkSession, path: str, at_tail: bool = False, cut: Cut | None = None) -> Cut | None:
    """The tail as of now if asked for, else the given cut, else no end."""
    return tail_cut(spark, path) if at_tail else cut


def _bound_of(cut: Cut, segment: Column) -> Column:
    if not cut:
        return F.lit(None).cast("bigint")
    segments = F.array(*[F.lit(s).cast("int") for s in cut])
    offsets = F.array(*[F.lit(o).cast("bigint") for o in cut.values()])
    return F.try_element_at(F.map_from_arrays(segments, offsets), segment)


def within(events: DataFrame, start: Cut | None = None, end: Cut | None = None) -> DataFrame:
    """Events at or after `start` and before `end`.

    A segment that `start` does not name is read from its head, one that `end` does not name lies after it. Beside the
    exact test per segment there is a coarse one that the Parquet reader can use to skip row groups.
    """
    if start:
        coarse = ~F.col("segment").isin(*start) | (F.col("offset") >= min(start.values()))
        bound = F.coalesce(_bound_of(start, F.col("segment")), F.lit(0).cast("bigint"))
        events = events.where(coarse).where(F.col("offset") >= bound)
    if end is not None:
        if end:
            events = events.where(F.col("segment").isin(*end) & (F.col("offset") < max(end.values())))
        events = events.where(F.coalesce(F.col("offset") < _bound_of(end, F.col("segment")), F.lit(False)))
    return events


def appends_within(positions: DataFrame, start: Cut | None = None, end: Cut | None = None) -> DataFrame:
    """The appends (writer, batch) of a positions table with at least one event between two cuts."""
    rows = positions.where("segment is not null")
    begun = within(rows.withColumn("offset", F.col("tail") - 1), start, None)
    return within(begun.withColumn("offset", F.col("head")), None, end).select("writer", "batch").distinct()


def read_appends(spark: SparkSession, path: str, appends: DataFrame, start: Cut | None, end: Cut | None) -> DataFrame:
    """The events of the named appends between two cuts; the driver lists one folder name for each append."""
    folders = [f"{data_folder(path)}/{append_name(row.writer, row.batch)}" for row in appends.collect()]
    if not folders:
        return spark.createDataFrame([], EVENT_SCHEMA)
    return within(spark.read.schema(EVENT_SCHEMA).parquet(*folders), start, end)


def read_append(spark: SparkSession, path: str, writer: str, batch: int) -> DataFrame:
    """The events of one append."""
    return spark.read.schema(EVENT_SCHEMA).parquet(f"{data_folder(path)}/{append_name(writer, batch)}")


def read_events(spark: SparkSession, path: str, start: Cut | None = None, end: Cut | None = None) -> DataFrame:
    """All committed appends, between two cuts; appends outside of them are not opened."""
    return read_appends(spark, path, appends_within(read_positions(spark, path), start, end), start, end)


def stream_events(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The stream as a streaming DataFrame, file by file as the files appear.

    For consumers that depend neither on the order between micro-batches nor on commits: files of an append that never
    commits come through as well, and an append that was tried again comes through twice. `streaming.follow` reads
    committed appends only, each once and whole.
    """
    reader = spark.readStream.schema(EVENT_SCHEMA).option("recursiveFileLookup", "true").options(**options)
    return reader.parquet(data_folder(path))


def as_text(events: DataFrame) -> DataFrame:
    """Add the payload as UTF-8 text in the column `line`."""
    return events.withColumn("line", utf8_text(F.col("event")))


