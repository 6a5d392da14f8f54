"""Incremental jobs. Each runs over landed files until they are used up, with its own checkpoint, and leaves a parquet table.

Files may arrive in any order, so no job drops or misjudges a row for being late. Row jobs use the file sink (exactly once). Window jobs
carry the open windows from batch to batch; windows that have closed are written once, and late rows for them become corrections: counts of
the same window add up when the table is read, and sessions that touch are joined then. A repeated batch overwrites its own folder. Alerts are decided by a keyed state operator that holds the recent days of
each rule and company and hands on signed changes; what is older than that is settled when the table is read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.windows import first_per_key
from ..session import fresh_path, setting
from ..sources import sinks

EPOCH = "__epoch"
#: Files of tables that are landed or streamed out: zstd, and ids that begin alike as differences.
COMPACT = {"compression": "zstd", "parquet.writer.version": "v2"}


def land(df: DataFrame, label: str, rows_per_file: int) -> str:
    """Put a table down as landed files of at most so many rows."""
    path = fresh_path(df.sparkSession, f"landing-{label}")
    df.write.option("maxRecordsPerFile", rows_per_file).options(**COMPACT).parquet(path)
    return path


#: Batches that a backlog is taken in, at most: a batch has a fixed cost, and a merge rewrites the months that it touches.
BATCHES = 8


def files_a_batch(spark: SparkSession, path: str, least: int) -> int:
    """Files that a batch takes: `least`, and of a large backlog so many that BATCHES batches take all of it."""
    files = sum(not name.startswith(("_", ".")) for name in sinks.names(spark, path))
    return max(least, -(-files // BATCHES))


def read_backlog(spark: SparkSession, path: str, schema, least: int) -> DataFrame:
    """Landed files in BATCHES batches at most, and `least` files a batch at least."""
    return read_landed(spark, path, schema, files_a_batch(spark, path, least))


def read_landed(spark: SparkSession, path: str, schema, files_per_batch: int) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


#: Files that a task holds open while it writes by partition. Up to so many it writes rows as they come; only what goes beyond is sorted first.
OPEN_FILES = 16


def append_table(stream: DataFrame, label: str, partition: list[str] = ()) -> DataFrame:
    """Run the stream to the end into a parquet table and return it."""
    spark = stream.sparkSession
    out = fresh_path(spark, label)
    writer = (stream.writeStream.outputMode("append").format("parquet").option("path", out).options(**COMPACT)
              .option("checkpointLocation", fresh_path(spark, f"{label}-checkpoint")))
    if partition:
        writer = writer.partitionBy(*partition)
    # a stream's sink takes the writer's version from the session, not from its options
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES)), setting(spark, "parquet.writer.version", COMPACT["parquet.writer.version"]):
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def batch_table(stream: DataFrame, label: str, per_batch, partition: str | None = None) -> DataFrame:
    """Run the stream to the end; `per_batch(batch, before)` gives the rows that a batch adds, `before` being the table up to there.

    Every batch has a folder of its own, which a repetition overwrites; `before` leaves that folder out.
    """
    spark = stream.sparkSession
    out = fresh_path(spark, label)
    nothing = per_batch(spark.createDataFrame([], stream.schema), None)

    def put(rows: DataFrame, epoch: int) -> None:
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(partition) if partition else writer).parquet(f"{out}/{EPOCH}={epoch}")

    put(nothing, -1)
    schema = T.StructType([*nothing.schema.fields, T.StructField(EPOCH, T.LongType())])

    def table():
        return spark.read.schema(schema).option("basePath", out).parquet(out)

    def write(batch: DataFrame, epoch: int) -> None:
        before = table().where(F.col(EPOCH) < epoch).drop(EPOCH) if epoch else None
        put(per_batch(batch.select(*stream.columns), before), epoch)

    (stream.writeStream.foreachBatch(write).option("checkpointLocation", fresh_path(spark, f"{label}-checkpoint"))
     .trigger(availableNow=True).start().awaitTermination())
    return table().drop(EPOCH)


def merge_table(stream: DataFrame, label: str, keys: list[str], partition: str, cluster: list[str], version: list[str] | None = None) -> DataFrame:
    """A partitioned fact that every micro-batch is merged into: one row per key, the latest by `version` or else of the latest batch.

    A batch adds its rows in a folder of its own, by partition and sorted inside a file; a repeated batch overwrites it. The latest of a key's rows is taken
    when the table is read, so a batch costs its own rows, however many partitions it touches, and the order of files doesn't
    matter with `version` columns. Rows without a key are rivals within their batch alone. What is read lies by key.
    """
    spark = stream.sparkSession
    out, columns = fresh_path(spark, label), stream.columns

    def put(rows: DataFrame, epoch: int) -> None:
        (rows.select(*columns).sortWithinPartitions(partition, *cluster).write.mode("overwrite").options(**COMPACT)
         .option("partitionOverwriteMode", "static").partitionBy(partition).parquet(f"{out}/{EPOCH}={epoch}"))

    (stream.writeStream.foreachBatch(put).option("checkpointLocation", fresh_path(spark, f"{label}-checkpoint"))
     .trigger(availableNow=True).start().awaitTermination())
    sinks.make(spark, out)
    schema = T.StructType([*stream.schema.fields, T.StructField(EPOCH, T.LongType())])
    added = spark.read.schema(schema).option("basePath", out).parquet(out).select(*columns, EPOCH)
    keyless = F.when(F.expr(" OR ".join(f"`{k}` IS NULL" for k in keys)), F.col(EPOCH)).alias("_alone")
    placed = added.select("*", keyless).repartition(*keys)
    return sinks.one_per_key(placed, [*keys, "_alone"], version or [EPOCH]).select(*columns)


def dedupe_table(stream: DataFrame, label: str, time: str, keys: list[str]) -> DataFrame:
    """The earliest row per key, whatever the order and distance of the files: keys belong to one day of `time`, so a batch is compared with the
    days that it touches, read by partition. A batch adds rows of new keys and rows that are earlier than those known; of a key's few
    rows the earliest is taken when the table is read. The days of a batch are read to the driver; the calendar bounds them."""
    day = "event_day"

    def new(batch: DataFrame, before: DataFrame | None) -> DataFrame:
        rows = first_per_key(batch.withColumn(day, F.to_date(time)), [day, *keys], [time])
        if before is None:
            return rows
        days = [r[0] for r in rows.select(day).distinct().collect()]
        known = before.where(F.col(day).isin(days)) if days else before.limit(0)
        first = known.groupBy(day, *keys).agg(F.min(time).alias("_known"))
        return rows.join(first, [day, *keys], "left").where(F.col("_known").isNull() | (F.col(time) < F.col("_known"))).select(*rows.columns)

    return first_per_key(batch_table(stream, label, new, day), [day, *keys], [time])


PART, LATE_PART, CLOSED, OPEN = "__part", "late", "closed", "open"
OPEN_DAYS = 7


def windowed_table(stream: DataFrame, label: str, partial, merge, open_days: float = OPEN_DAYS) -> DataFrame:
    """Run the stream to the end; rows per window, in parts that `merge` makes one of when the table is read.

    `partial(batch)` gives a batch's windows (start, end, keys, n) and `merge(parts, more keys)` unites windows of the same place. A batch
    folder has three parts: windows still open, carried on from the folder before; windows that closed, because they ended `open_days`
    before the newest start known until then; and corrections, rows of this batch for windows that had closed by then. Only the open
    part is read again, and the one before the last is removed, so a batch costs its own rows and the open windows, not what has closed.
    A repeated batch finds the same open part and overwrites its own folder.
    """
    spark = stream.sparkSession
    out = fresh_path(spark, label)
    nothing = partial(spark.createDataFrame([], stream.schema))
    start, end = nothing.columns[:2]
    kept = T.StructType([*nothing.schema.fields, T.StructField(PART, T.StringType())])
    last = [-1]

    def folder(epoch: int) -> str:
        return f"{out}/{EPOCH}={epoch}"

    def put(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(PART).parquet(folder(epoch))
        last[0] = epoch

    def micros(column: str) -> Column:
        return F.unix_micros(F.col(column).cast("timestamp"))

    def write(batch: DataFrame, epoch: int) -> None:
        rows, clock = partial(batch.select(*stream.columns)), None
        where = f"{folder(epoch - 1)}/{PART}={OPEN}"
        if sinks.exists(spark, where):
            before = spark.read.schema(nothing.schema).parquet(where)
            newest = before.agg(F.max(micros(start))).first()[0]
            clock = None if newest is None else newest - int(open_days * DAY)
        ended = F.lit(False) if clock is None else micros(end) <= clock
        parts = rows.withColumn(PART, F.when(ended, LATE_PART).otherwise(OPEN))
        if clock is not None:
            parts = parts.unionByName(before.withColumn(PART, F.when(ended, CLOSED).otherwise(OPEN)))
        put(merge(parts, [PART]), epoch)
        sinks.remove(spark, f"{folder(epoch - 2)}/{PART}={OPEN}")

    put(nothing.withColumn(PART, F.lit(OPEN)), -1)
    (stream.writeStream.foreachBatch(write).option("checkpointLocation", fresh_path(spark, f"{label}-checkpoint"))
     .trigger(availableNow=True).start().awaitTermination())
    table = spark.read.schema(T.StructType([*kept.fields, T.StructField(EPOCH, T.LongType())])).option("basePath", out).parquet(out)
    return merge(table.where((F.col(PART) != OPEN) | (F.col(EPOCH) == last[0])).drop(PART, EPOCH), [])


def window_counts(stream: DataFrame, label: str, window: Column, keys: list[str], open_days: float = OPEN_DAYS) -> DataFrame:
    """Rows per window and keys. Counts of the same window add up."""
    def counted(batch):
        return batch.groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n")).select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")

    def added(parts, more):
        return parts.groupBy("window_start", "window_end", *keys, *more).agg(F.sum("n").alias("n"))

    return windowed_table(stream, label, counted, added, open_days).drop("window_end")


def tumbling_counts(stream: DataFrame, label: str, time: str, keys: list[str], size: str, open_days: float = OPEN_DAYS) -> DataFrame:
    return window_counts(stream, label, F.window(time, size), keys, open_days)


def sliding_counts(stream: DataFrame, label: str, time: str, keys: list[str], size: str, slide: str, open_days: float = OPEN_DAYS) -> DataFrame:
    return window_counts(stream, label, F.window(time, size, slide), keys, open_days)


def sessions(stream: DataFrame, label: str, time: str, keys: list[str], gap: str, open_days: float = OPEN_DAYS) -> DataFrame:
    """Sessions per keys. Those that touch, across batches and corrections, are one."""
    def found(batch):
        return batch.groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count("*").alias("n")).select(
            F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *keys, "n")

    return windowed_table(stream, label, found, lambda parts, more: join_sessions(parts, [*keys, *more]), open_days)


def join_sessions(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sessions that overlap (an end is a row's time plus the gap) as one."""
    order = Window.partitionBy(*keys).orderBy("session_start", "session_end")
    reach = F.max("session_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = parts.withColumn("begins", F.coalesce(F.col("session_start") >= reach, F.lit(True)).cast("int"))
    numbered = marked.withColumn("session", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "session").agg(F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), F.sum("n").alias("n")).select(
        "session_start", "session_end", *keys, "n")


STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
HOUR, DAY = 3_600_000_000, 86_400_000_000  # microseconds
CANDIDATE, FIRED, WITHDRAWN, LATE = 0, 1, -1, 2
CHANGES = "rule_code string, entity_code string, raised_at bigint, change int"


class Cooldown(StatefulProcessor):
    """Decides one rule and company's alerts as its candidates come, in any order.

    State: per day the candidates' times and those that fired, for the last `keep` days that the key has seen, and the last alert before
    these. New candidates are decided again from the earliest of them on, until the chain meets an alert that had fired before; only
    the days on the way are read. Days that fall behind are dropped, and candidates that come for them are handed on as late.
    """

    def __init__(self, hours: int, keep: int):
        self.gap, self.keep = hours * HOUR, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.days = handle.getMapState("days", "day long", "times array<long>, fired array<long>")
        self.before = handle.getValueState("before", "day long, last long")

    def _day(self, day: int) -> tuple[list, list]:
        found = self.days.getValue((day,)) if self.days.containsKey((day,)) else ([], [])
        return list(found[0]), list(found[1])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = sorted({int(t) for part in rows for t in part["at"]})
        first, last = self.before.get() if self.before.exists() else (None, None)  # the first day still held, and the last alert before it
        out = [(t, LATE) for t in new if first is not None and t // DAY < first]
        new = [t for t in new if first is None or t // DAY >= first]
        if new:
            stored = {k[0] for k in self.days.keys()} if self.days.exists() else set()
            held = {d: self._day(d) if d in stored else ([], []) for d in sorted({t // DAY for t in new})}
            for t in new:
                times = held[t // DAY][0]
                at = bisect_left(times, t)
                if at == len(times) or times[at] != t:
                    times.insert(at, t)
            known = sorted(stored | set(held))
            out += self._decide(new, held, known, last)
            edge = known[-1] - self.keep
            for d, (times, fired) in held.items():
                if d > edge:  # the others would go at once
                    self.days.updateValue((d,), (times, fired))
            gone = [d for d in known if d <= edge]
            for d in gone:
                fired = held[d][1] if d in held else self._day(d)[1]
                last = fired[-1] if fired else last
                if d in stored:
                    self.days.removeKey((d,))
            if gone:
                self.before.update((edge + 1, last))
        named = {c: pd.Series([key[i]] * len(out), dtype=object) for i, c in enumerate(("rule_code", "entity_code"))}
        yield pd.DataFrame({**named, "raised_at": pd.Series([t for t, _ in out], dtype="int64"), "change": pd.Series([c for _, c in out], dtype="int32")})

    def _decide(self, new: list, held: dict, known: list, last: int | None) -> list:
        """Changes (time, FIRED or WITHDRAWN) when candidates are decided anew from the first new one on; `held` takes the days that were read."""
        out, start = [], new[0]

        def of(day):
            if day not in held:
                held[day] = self._day(day)
            return held[day]

        for day in reversed([d for d in known if d <= start // DAY]):
            earlier = [t for t in of(day)[1] if t < start]
            if earlier:
                last = earlier[-1]
                break
        for day in [d for d in known if d >= start // DAY]:
            times, fired = of(day)
            now, settled = [t for t in fired if t < start], False
            for t in times[bisect_left(times, start):]:
                if last is None or t >= last + self.gap:
                    last = t
                    now.append(t)
                    if t in fired and t >= new[-1]:  # from here on nothing changes
                        now += [x for x in fired if x > t]
                        settled = True
                        break
            out += [(t, FIRED) for t in now if t not in fired] + [(t, WITHDRAWN) for t in fired if t not in now]
            held[day] = (times, now)
            if settled:
                break
        return out


KEEP_DAYS = 400


def cooldown_changes(stream: DataFrame, label: str, hours: int, keep_days: int = KEEP_DAYS) -> tuple[DataFrame, DataFrame]:
    """Runs the stream to the end: (candidates as they came, changes: rule_code, entity_code, raised_at in microseconds, change)."""
    spark = stream.sparkSession
    named = stream.select("rule_code", "entity_code", "raised_at").where("raised_at IS NOT NULL")
    before = spark.conf.get(STATE_STORE[0], None)
    spark.conf.set(*STATE_STORE)
    try:
        candidates = append_table(named, label)
        decided = named.select("rule_code", "entity_code", F.unix_micros("raised_at").alias("at")).groupBy("rule_code", "entity_code").transformWithStateInPandas(
            statefulProcessor=Cooldown(hours, keep_days), outputStructType=CHANGES, outputMode="Append", timeMode="None")
        changes = append_table(decided, f"{label}-changes")
    finally:
        spark.conf.set(STATE_STORE[0], before) if before else spark.conf.unset(STATE_STORE[0])
    return candidates, changes


def cooldown_table(stream: DataFrame, label: str, hours: int, keep_days: int = KEEP_DAYS) -> DataFrame:
    """Alerts that fire out of all candidates of the stream, in the order of their times, not of their arrival.

    The changes of an alert add up to whether it fires. Rules and companies with late candidates, beyond the days that the state holds, are
    decided again from all their candidates when the table is read.
    """
    keys = ["rule_code", "entity_code"]
    candidates, changes = cooldown_changes(stream, label, hours, keep_days)
    late = changes.where(F.col("change") == LATE).select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = F.col("rule_code").eqNullSafe(F.col("_rule_code")) & F.col("entity_code").eqNullSafe(F.col("_entity_code"))
    summed = changes.where(F.col("change") != LATE).groupBy(*keys, "raised_at").agg(F.sum("change").alias("n")).where("n > 0")
    settled = summed.join(late, same, "left_anti").select(*keys, F.timestamp_micros("raised_at").alias("raised_at"))
    return settled.unionByName(fired(candidates.join(late, same, "left_semi"), hours))


def fired(candidates: DataFrame, hours: int) -> DataFrame:
    """Per rule and company the first candidate and then each first one at least `hours` after the last that fired.

    Rows stream past in order, and a task holds one batch and the last firing. One rule and company is one chain, in one task.
    """
    keys = ["rule_code", "entity_code"]
    gap = pd.Timedelta(hours=hours)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, last = None, None
        for batch in batches:
            out = []
            for name, group in batch.groupby(keys, sort=False, dropna=False):
                times = group.raised_at.reset_index(drop=True)
                name = tuple(None if pd.isna(x) else x for x in name)
                if name != key:
                    key, last = name, None
                at = 0 if last is None else int(times.searchsorted(last + gap))
                while at < len(times):
                    last = times[at]
                    out.append((*name, last))
                    at = int(times.searchsorted(last + gap))
            yield pd.DataFrame(out, columns=[*keys, "raised_at"])

    ordered = candidates.select(*keys, "raised_at").where("raised_at IS NOT NULL").repartition(*keys).sortWithinPartitions(*keys, "raised_at")
    return ordered.mapInPandas(run, "rule_code string, entity_code string, raised_at timestamp")
