"""The six jobs. Each reads its options, composes operators and starts a streaming query.

Every job keeps its progress in `checkpointLocation` and may be stopped and started again with the same options.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.config import Options
from millrace.functions.columns import column
from millrace.functions.render import csv_line, utf8_bytes
from millrace.operators import dedup
from millrace.operators.flatten import flatten
from millrace.operators.parse import FITS, parse_records, records_or_not
from millrace.session import scratch_folder
from millrace.sinks.console import print_lines, print_records
from millrace.sinks.events import append_events
from millrace.sinks.files import write_batch, written_batch
from millrace.sources import events as stream
from millrace.sources.generator import event_numbers, sample_event_lines, sample_events
from millrace.streaming import marks
from millrace.streaming.follow import APPENDS_PER_BATCH, follow

FILE_INTERVAL_MS = 60_000
COPY_INTERVAL_MS = 10_000

log = logging.getLogger("millrace")

# Stream columns under names that no Avro field can have.
SEGMENT, OFFSET, EVENT, LINE = "millrace:segment", "millrace:offset", "millrace:event", "millrace:line"
UNFIT = "millrace:unfit"
ORDER = (OFFSET, SEGMENT)


def _renamed(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("segment").alias(SEGMENT), F.col("offset").alias(OFFSET), F.col("event").alias(EVENT)
    )


def _text_lines(events: DataFrame) -> DataFrame:
    return stream.as_text(events).select(
        F.col("segment").alias(SEGMENT), F.col("offset").alias(OFFSET), "line"
    )


class Batch:
    """One micro-batch of a job: its number, and what to log and keep of the rows it rejects.

    With dedup, the keyed rows of a batch are written beside the checkpoint before anything else, so that events are
    parsed once: marks, counts, comparison and output read what is there. If rejects are wanted, so are the judged rows,
    from which both outputs are read. A batch that runs again writes both anew.
    """

    def __init__(self, options: Options, writer: str, batch_id: int):
        self.options = options
        self.batch_id = batch_id
        self.name = f"{writer}-{batch_id}"
        self.folder = f"{checkpoint_folder(options)}/batch/{batch_id}"
        self.deduplicated = False
        self.kept: Observation | None = None
        self.rejected: DataFrame | None = None

    @property
    def with_rejects(self) -> bool:
        return bool(self.options.get("rejectsOutput"))

    def written(self, rows: DataFrame, name: str) -> DataFrame:
        folder = f"{self.folder}/{name}"
        rows.write.mode("overwrite").parquet(folder)
        return rows.sparkSession.read.schema(rows.schema).parquet(folder)

    def deduplicate(self, keyed: dedup.Keyed) -> DataFrame:
        """Rows that rise over all earlier ones of this and the earlier batches."""
        self.kept, self.deduplicated = Observation(), True
        keyed = dedup.Keyed(self.written(keyed.rows, "keyed"), keyed.keys, keyed.payload)
        compared = marks.compare_batch(keyed, marks_folder(self.options), self.batch_id, ORDER, _split_width(self.options))
        kept = self.split(marks.judged(keyed, compared)) if self.with_rejects else marks.kept(keyed, compared)
        return kept.observe(self.kept, F.count(F.lit(1)).alias("rows"))

    def split(self, judged: DataFrame) -> DataFrame:
        """The rows whose `REASON` is null; the others are remembered for the rejects folder."""
        judged = self.written(judged, "judged")
        self.rejected = judged.where(F.col(dedup.REASON).isNotNull())
        return judged.where(F.col(dedup.REASON).isNull()).drop(dedup.REASON)

    def finish(self, written: bool = True) -> None:
        """After the output: write the rejects if they are wanted, log the counts, drop what was kept of the batch.

        `written` is false for a batch whose output was there already: it was not computed again, so nothing was
        counted.
        """
        spark = SparkSession.active()
        if self.rejected is not None:
            rows = self.rejected
            fields = [c for c in rows.columns if c not in (SEGMENT, OFFSET, LINE, dedup.REASON)]
            event = F.to_json(F.struct(*[column(c) for c in fields])) if fields != ["line"] else F.col("line")
            # Text that is no record stands there as it came.
            event = F.coalesce(F.col(LINE), event) if LINE in rows.columns else event
            rows = rows.select(
                F.col(SEGMENT).alias("_segment"), F.col(OFFSET).alias("_offset"), F.col(dedup.REASON).alias("reason"),
                event.alias("event"))
            rows.write.mode("overwrite").json(f"{self.options.get('rejectsOutput').rstrip('/')}/batch={self.name}")
        if written and self.deduplicated:
            unusable = marks.counts(spark, marks_folder(self.options), self.batch_id)
            usable = unusable.pop(None, 0)
            # Spark cuts an observation out of a plan that it finds empty; there is nothing to wait for then.
            kept = self.kept.get["rows"] if usable else 0
            log.warning(
                "batch %s: %s events, %s kept, %s duplicates, unusable: %s",
                self.batch_id, usable + sum(unusable.values()), kept, usable - kept, dict(sorted(unusable.items())) or "none",
            )
        files, target = stream.hadoop_path(spark, self.folder)
        files.delete(target, True)


def _split_width(options: Options) -> int:
    width = options.integer("splitWidth", dedup.SPLIT_WIDTH)
    if width < 1:
        raise ValueError("splitWidth must be positive")
    return width


def _deduplicated(keyed: dedup.Keyed, options: Options, batch: Batch | None) -> DataFrame:
    if batch is None:
        return dedup.keep_ascending(keyed, ORDER, _split_width(options))
    return batch.deduplicate(keyed)


def checkpoint_folder(options: Options) -> str:
    default = options.get("output") or options.get("output-stream")
    if options.get("checkpointLocation"):
        return options.get("checkpointLocation").rstrip("/")
    if not default:
        raise ValueError("option --checkpointLocation is required")
    return f"{default.rstrip('/')}/_checkpoint"


def marks_folder(options: Options) -> str:
    return f"{checkpoint_folder(options)}/marks"


def file_lines(events: DataFrame, options: Options, batch: Batch | None = None) -> DataFrame:
    """Event text as it is, without duplicates if keys and counter are set."""
    lines = _text_lines(events)
    if dedup.dedup_enabled(options.keys, options.counter):
        lines = _deduplicated(dedup.key_json(lines, options.keys, options.counter), options, batch)
    return lines.select("line")


def records(
    events: DataFrame, options: Options, read_file: Callable[[str], str], batch: Batch | None = None
) -> DataFrame:
    """Events parsed by the Avro schema, deduplicated and flattened as the options say."""
    schema = options.avro_schema(read_file)
    dedup_on = dedup.dedup_enabled(options.keys, options.counter)
    on_error = options.get("onError") or ("drop" if dedup_on else "fail")
    lines = _text_lines(events).withColumnRenamed("line", LINE)
    if on_error == "fail":
        parsed = parse_records(lines, schema, LINE, on_error, keep=(SEGMENT, OFFSET))
    else:
        with_text = [LINE] if batch and batch.with_rejects else []
        parsed = records_or_not(lines, schema, LINE, keep=(SEGMENT, OFFSET, *with_text))
        if with_text:
            parsed = parsed.withColumn(LINE, F.when(~F.col(FITS), F.col(LINE)))
        parsed = parsed.withColumn(UNFIT, ~F.col(FITS)).drop(FITS)
    unfit = UNFIT if UNFIT in parsed.columns else None
    if dedup_on:
        parsed = _deduplicated(dedup.key_records(parsed, options.keys, options.counter, unfit), options, batch)
    elif unfit and batch and batch.with_rejects:
        parsed = batch.split(parsed.withColumn(dedup.REASON, F.when(F.col(UNFIT), dedup.MISFIT)).drop(UNFIT))
    elif unfit:
        parsed = parsed.where(~F.col(UNFIT)).drop(UNFIT)
    parsed = parsed.drop(SEGMENT, OFFSET, LINE)
    if options.flag("flatten"):
        parsed = flatten(parsed, options.get("onMismatch", "fail"))
    return parsed


def csv_lines(rows: DataFrame, options: Options) -> DataFrame:
    null_value = options.values.get("nullValue")
    return rows.select(csv_line(rows, null_value, options.flag("quoteCsv")).alias("line"))


def copied_events(events: DataFrame, options: Options, batch: Batch | None = None) -> DataFrame:
    """Events as bytes, without duplicates if keys and counter are set."""
    rows = _renamed(events)
    if dedup.dedup_enabled(options.keys, options.counter):
        rows = _deduplicated(dedup.key_bytes(rows, options.keys, options.counter, EVENT), options, batch)
    return rows


def _text_reader(spark: SparkSession) -> Callable[[str], str]:
    def read(path: str) -> str:
        return spark.read.text(path, wholetext=True).first().value

    return read


def _follow(spark: SparkSession, options: Options, default_name: str, handle, interval_ms: int) -> StreamingQuery:
    source = options.stream("input")
    name = options.get("jobName", default_name)
    if options.get("parallelism"):
        spark.conf.set("spark.sql.shuffle.partitions", options.get("parallelism"))
    _, start, end = _begin(spark, options)
    return follow(
        spark,
        source.path,
        handle,
        f"{checkpoint_folder(options)}/{default_name}",
        start,
        end,
        options.integer("checkpointIntervalMs", interval_ms),
        name,
        options.integer("appendsPerBatch", APPENDS_PER_BATCH),
    )


def _begin(spark: SparkSession, options: Options) -> tuple[str, stream.Cut | None, stream.Cut | None]:
    """What must stay the same when the job restarts: its writer name and the cuts as first resolved.

    Both live beside the checkpoint. A job with a new checkpoint numbers its batches from 0 again and so gets a new
    writer name, under which the target stream has none of its batches.
    """
    folder = f"{checkpoint_folder(options)}/begin"
    if stream.path_exists(spark, f"{folder}/_SUCCESS"):
        row = spark.read.json(folder, schema="writer string, start string, end string").first()
        return row.writer, stream.parse_cut(row.start), stream.parse_cut(row.end)
    writer, start, end = uuid.uuid4().hex, None, None
    if options.get("input-stream"):
        source = options.stream("input")
        stream.create_stream(spark, source.path)
        start = stream.resolve_start(spark, source.path, source.start_at_tail, source.start_cut)
        end = stream.resolve_end(spark, source.path, source.end_at_tail, source.end_cut)
    values = {"writer": writer, "start": stream.cut_text(start), "end": stream.cut_text(end)}
    row = spark.range(1).select(*[F.lit(text).alias(name) for name, text in values.items()])
    row.coalesce(1).write.mode("overwrite").json(folder)
    return writer, start, end


def _console_options(spark: SparkSession, options: Options) -> Options:
    if options.get("checkpointLocation"):
        return options
    return Options({**options.values, "checkpointLocation": scratch_folder(spark, "console")})


def console_lines(events: DataFrame) -> DataFrame:
    """Event text as the console job prints it."""
    return _text_lines(events)


def stream_to_console(spark: SparkSession, options: Options) -> StreamingQuery:
    options = _console_options(spark, options)

    def handle(events: DataFrame, batch_id: int, bucket: str) -> None:
        print_lines(console_lines(events))

    return _follow(spark, options, "stream-to-console", handle, COPY_INTERVAL_MS)


def stream_to_file(spark: SparkSession, options: Options) -> StreamingQuery:
    output = options.required("output")
    writer, _, _ = _begin(spark, options)

    def handle(events: DataFrame, batch_id: int, bucket: str) -> None:
        batch = Batch(options, writer, batch_id)
        write_batch(file_lines(events, options, batch), output, batch.name, bucket)
        batch.finish()

    return _follow(spark, options, "stream-to-file", handle, FILE_INTERVAL_MS)


def stream_to_csv_file(spark: SparkSession, options: Options) -> StreamingQuery:
    output, read_file = options.required("output"), _text_reader(spark)
    options.avro_schema(read_file)
    writer, _, _ = _begin(spark, options)

    def handle(events: DataFrame, batch_id: int, bucket: str) -> None:
        batch = Batch(options, writer, batch_id)
        lines = csv_lines(records(events, options, read_file, batch), options)
        write_batch(lines, output, batch.name, bucket)
        if options.flag("logOutputRecords"):
            print_lines(written_batch(lines, output, batch.name, bucket), prefix="output")
        batch.finish()

    return _follow(spark, options, "stream-to-csv-file", handle, FILE_INTERVAL_MS)


def stream_to_parquet_file(spark: SparkSession, options: Options) -> StreamingQuery:
    output, read_file = options.required("output"), _text_reader(spark)
    options.avro_schema(read_file)
    writer, _, _ = _begin(spark, options)

    def handle(events: DataFrame, batch_id: int, bucket: str) -> None:
        batch = Batch(options, writer, batch_id)
        rows = records(events, options, read_file, batch)
        write_batch(rows, output, batch.name, bucket, "parquet")
        if options.flag("logOutputRecords"):
            print_records(written_batch(rows, output, batch.name, bucket, "parquet"))
        batch.finish()

    return _follow(spark, options, "stream-to-parquet-file", handle, FILE_INTERVAL_MS)


def stream_to_stream(spark: SparkSession, options: Options) -> StreamingQuery:
    target = options.stream("output")
    writer, _, _ = _begin(spark, options)
    routing_key = options.get("fixedRoutingKey")

    def handle(events: DataFrame, batch_id: int, bucket: str) -> None:
        bounds = events.agg(F.min("offset").alias("low"), F.max("offset").alias("high")).first()
        batch = Batch(options, writer, batch_id)
        written = append_events(
            copied_events(events, options, batch),
            target.path,
            writer,
            batch_id,
            event=F.col(EVENT),
            order=F.col(OFFSET),  # unique over all segments of a stream
            routing_key=F.lit(routing_key),
            segments=target.segments,
            span=(bounds.low, bounds.high) if bounds.low is not None else (0, -1),
        )
        batch.finish(written)

    return _follow(spark, options, "stream-to-stream", handle, COPY_INTERVAL_MS)


def sample_data_generator(spark: SparkSession, options: Options) -> StreamingQuery:
    target = options.stream("output")
    writer, _, _ = _begin(spark, options)
    sensors = options.integer("numSensors", 1)
    size = options.integer("dataSizeBytes", 10)
    stream.create_stream(spark, target.path)
    numbers = event_numbers(spark, options.number("eventsPerSec", 1.0))

    def handle(batch: DataFrame, batch_id: int) -> None:
        lines = sample_event_lines(sample_events(batch, sensors, size))
        append_events(
            lines,
            target.path,
            writer,
            batch_id,
            event=utf8_bytes(column("line")),
            order=F.col("eventNumber") * max(sensors, 1) + F.col("sensorId"),
            routing_key=F.col("sensorId").cast("string"),
            segments=target.segments,
        )
        print_lines(stream.as_text(stream.read_append(spark, target.path, writer, batch_id)))

    return (
        numbers.writeStream.foreachBatch(handle)
        .queryName(options.get("jobName", "sample-data-generator"))
        .option("checkpointLocation", f"{checkpoint_folder(options)}/sample-data-generator")
        .trigger(processingTime=f"{options.integer('checkpointIntervalMs', COPY_INTERVAL_MS)} milliseconds")
        .start()
    )


def run(spark: SparkSession, job: str, options: Options) -> None:
    """Run a job until it ends. One with an end cut that lies ahead of the stream waits for the events up to it."""
    if job == "stream-to-console":
        options = _console_options(spark, options)
    while True:
        JOBS[job](spark, options).awaitTermination()
        _, _, end = _begin(spark, options)
        if end is None:
            return
        tails = stream.tail_cut(spark, options.stream("input").path)
        if all(tails.get(segment, 0) >= offset for segment, offset in end.items()):
            return
        time.sleep(options.integer("checkpointIntervalMs", COPY_INTERVAL_MS) / 1000)


JOBS = {
    "stream-to-console": stream_to_console,
    "stream-to-file": stream_to_file,
    "stream-to-csv-file": stream_to_csv_file,
    "stream-to-parquet-file": stream_to_parquet_file,
    "stream-to-stream": stream_to_stream,
    "sample-data-generator": sample_data_generator,
}
