"""Structured Streaming forms of ingest, dedup, idempotent append, the
delayed-outcome join and the per-scrape-window counts.

Sources are file streams with a declared schema; runs use
``trigger(availableNow=True)`` so a scheduled job drains what is staged and
stops (the timer-driven polling of the source system).  Every query keeps its
checkpoint in the shared work folder, so a lost executor or driver restart
resumes from the last committed batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_path
from ..sources.published import PublishedTable, move_files
from ..util import kept_table

# --------------------------------------------------------------------------- running
def run_available_now(stream: DataFrame, sink: str | Callable, checkpoint: str,
                      mode: str = "append", fmt: str = "parquet") -> None:
    """Drain everything available, then stop.  ``sink`` is a path (file sink)
    or a ``foreachBatch`` function."""
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True)
    if callable(sink):
        q = w.foreachBatch(sink).start()
    else:
        q = w.format(fmt).option("path", sink).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = None, archive_dir: str | None = None) -> DataFrame:
    """File stream with a declared schema.  ``archive_dir`` moves every file
    out of the staging folder once its batch is committed (the file source's
    ``cleanSource=archive``), so staging only holds work still to do."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return r.load(path)


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ): cast in place."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


# --------------------------------------------------------------------------- operators
def stream_normalise(spark: SparkSession, in_dir: str, schema: T.StructType,
                     transform: Callable[[DataFrame], DataFrame], out_dir: str, checkpoint: str,
                     fmt: str = "parquet") -> DataFrame:
    """Stateless: the batch normalisation functions applied to a file stream,
    written to ``out_dir``; returns the written table."""
    run_available_now(transform(read_stream(spark, in_dir, schema, fmt)), out_dir, checkpoint)
    return spark.read.parquet(out_dir)


def stream_dedup(df: DataFrame, key: str | list, ts: str, delay: str) -> DataFrame:
    """First arrival per key; state is kept only while the watermark (event
    time minus ``delay``) can still see duplicates."""
    keys = [key] if isinstance(key, str) else list(key)
    return event_time(df, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def append_batch(table: PublishedTable, key: str, order: list) -> Callable:
    """``foreachBatch`` function: publishes the batch's first row per key, minus keys the table has (only the
    batch's tags are read).  A batch that was published is skipped."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        table.publish(batch_id, batch, key, order)
    return apply


LEDGER = T.StructType([T.StructField("file", T.StringType()), T.StructField("status", T.StringType()),
                       T.StructField("n_rows", T.LongType()), T.StructField("n_bad_rows", T.LongType())])


def ingest_stream(spark: SparkSession, in_dir: str, table: PublishedTable, checkpoint: str, schema: T.StructType,
                  key: str, order: list, tag: Column, bad_row: Column | None = None, max_length: dict[str, int] | None = None,
                  fmt: str = "parquet", max_files: int | None = None, moved_to: tuple[str, str] | None = None,
                  fail_after: str | None = None) -> None:
    """Take each staged file once: conform it to the table with a verdict on every cell, reject a file wholly when any
    of its rows has a verdict or fails ``bad_row`` (a rule on the raw row), and publish as one step the accepted rows
    (first per ``key``, ``tag`` computed from the raw row and ``file``), the rejected rows as they came with their
    verdicts, and one ledger row per file (status completed / error).  ``moved_to`` then takes the files of a published
    batch to a (completed, error) folder; a replay moves what a lost driver did not."""
    from ..sources.table import load_ledger, route_files, split_routes, with_verdicts
    src = read_stream(spark, in_dir, schema, fmt, max_files=max_files).withColumn("file", F.col("_metadata.file_path"))
    target = T.StructType([f for f in table.schema.fields if f.name != table.tag])

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        ruled = batch.select("*", F.struct(*batch.columns).alias("__raw"), tag.alias("__tag"),
                             (F.lit(False) if bad_row is None else F.coalesce(bad_row, F.lit(True))).alias("__rule"))
        judged = with_verdicts(ruled, target, key, max_length, keep=["__raw", "__tag", "__rule", F.col("file").alias("__file")])
        routed = kept_table(route_files(judged, "__file", (F.size("verdicts") > 0) | F.col("__rule")), "routed")
        ok, bad = split_routes(routed)
        ledger = load_ledger(routed, "__file").withColumnRenamed("__file", "file")
        table.publish(batch_id, ok.withColumnRenamed("__tag", table.tag).select(*table.schema.names), key, order, ledger,
                      bad.select("__raw.*", "verdicts"), fail_after)
        if moved_to:
            move_files(spark, ledger, "file", *moved_to)
    run_available_now(src, per_batch, checkpoint)


def stream_outcome(snap: DataFrame, out: DataFrame, key: str, snap_ts: str, out_ts: str,
                   lo: str = "24 hours", hi: str = "48 hours", delay: str = "1 hour",
                   how: str = "inner") -> DataFrame:
    """Stream-stream interval join: outcomes of the same key in
    [t + lo, t + hi).  Both sides carry watermarks, so state is dropped once
    no future row can match.  ``how='left_outer'`` also emits snapshots
    without an outcome once the watermark passes t + hi.  The result is that
    of a range join - every matching (snapshot, outcome) pair, so a key with
    many outcomes in the window yields many rows; ``stream_outcome_asof``
    emits one row per snapshot (the earliest outcome) and forms no pairs."""
    s = event_time(snap, snap_ts).withWatermark(snap_ts, delay).alias("s")
    o = event_time(out, out_ts).withWatermark(out_ts, delay).alias("o")
    cond = ((F.col(f"s.{key}") == F.col(f"o.{key}"))
            & (F.col(f"o.{out_ts}") >= F.col(f"s.{snap_ts}") + F.expr(f"INTERVAL {lo}"))
            & (F.col(f"o.{out_ts}") < F.col(f"s.{snap_ts}") + F.expr(f"INTERVAL {hi}")))
    return s.join(o, cond, how)


def scrape_window(df: DataFrame, ts: str, label: str, width: str = "155 minutes",
                  delay: str = "1 hour") -> DataFrame:
    """Rows and positives per tumbling window of the scrape period."""
    d = event_time(df, ts).withWatermark(ts, delay)
    return d.groupBy(F.window(ts, width).alias("w")).agg(
        F.count(F.lit(1)).alias("n_posts"), F.sum(F.col(label).cast("long")).alias("n_positive"))


def stage_copy(df: DataFrame, name: str, partition_by: str | None = None) -> str:
    """Write a batch to a new folder under the shared work folder, as staged
    input for a stream (one file per partition value when partitioned)."""
    path = fresh_path(df.sparkSession, name)
    if partition_by:
        df.repartition(partition_by).write.partitionBy(partition_by).parquet(path)
    else:
        df.write.parquet(path)
    return path


# State groups per time bucket (keys are hashed into this many).  Fixed for
# the life of a checkpoint, since it is part of the state key.  A group holds
# about (rows of two time buckets) / ASOF_KEY_BUCKETS rows, and each group is
# one Python call: few buckets amortise the call, many bound the state.  Size
# it per deployment (tens of thousands on a large cluster).
ASOF_KEY_BUCKETS = 64


def stream_outcome_asof(snap: DataFrame, out: DataFrame, key: str, snap_ts: str, out_ts: str,
                        snap_id: str, out_id: str, payload: list[str] | None = None,
                        lo: str = "24 hours", hi: str = "48 hours", delay: str = "1 hour",
                        key_buckets: int = ASOF_KEY_BUCKETS) -> DataFrame:
    """Streaming form of ``outcome_after``: for every snapshot, the earliest
    outcome of its key in [t + lo, t + hi) (ties by outcome id), emitted once
    the watermark passes t + hi (so the answer is final).

    State groups are (hash bucket of the key, time bucket of width hi - lo):
    many keys share a group, so one Python call serves many keys, and a hot
    key is still split by time.  A group's state holds its pending snapshots
    and the outcomes a pending or future snapshot can still use, both bounded
    by the watermark.  Matching is a pandas ``merge_asof`` by key (forward,
    exact times included) over the group's rows: no (snapshot, outcome)
    pairs are formed.

    Output: key, snap_id, snap_ts, ``out_<out_id>``, ``out_<out_ts>`` and
    ``out_<p>`` for each payload column (null when there is no outcome)."""
    import json

    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    from ..operators.outcome import _seconds

    payload = list(payload or [])
    lo_us, hi_us = int(_seconds(lo) * 1_000_000), int(_seconds(hi) * 1_000_000)
    key_type = snap.schema[key].dataType
    sid_type = snap.schema[snap_id].dataType
    oid_type = out.schema[out_id].dataType
    fields = [T.StructField(key, key_type), T.StructField(snap_id, sid_type),
              T.StructField(snap_ts, T.TimestampType()),
              T.StructField(f"out_{out_id}", oid_type), T.StructField(f"out_{out_ts}", T.TimestampType())]
    fields += [T.StructField(f"out_{p}", out.schema[p].dataType) for p in payload]
    out_schema = T.StructType(fields)
    names = [f.name for f in out_schema.fields]
    # state: JSON arrays of [us, key json, record] rows
    state_schema = T.StructType([T.StructField("pending", T.StringType()), T.StructField("outs", T.StringType())])

    def us(col):
        return F.unix_micros(F.col(col).cast("timestamp"))

    s = event_time(snap, snap_ts)
    o = event_time(out, out_ts)
    # A snapshot belongs to the time bucket of t + lo; an outcome at ot can
    # serve snapshots whose t + lo lies in (ot - (hi - lo), ot], i.e. its own
    # bucket and the one before, so it is sent to both.  Keys (as JSON text,
    # equal exactly when the values are) are hashed into ``key_buckets``.
    width = hi_us - lo_us
    kj = F.to_json(F.struct(F.col(key).alias("k")))
    bk = F.pmod(F.xxhash64(F.col(key)), F.lit(key_buckets)).cast("int")
    u = (s.select(bk.alias("__bk"), F.col(snap_ts).alias("__t"), F.lit(0).alias("__kind"),
                  us(snap_ts).alias("__us"), F.floor((us(snap_ts) + lo_us) / width).alias("__g"),
                  kj.alias("__k"), F.to_json(F.struct(F.col(snap_id).alias("id"))).alias("__j"))
         .unionByName(o.select(bk.alias("__bk"), F.col(out_ts).alias("__t"), F.lit(1).alias("__kind"),
                               us(out_ts).alias("__us"),
                               F.explode(F.array(F.floor(us(out_ts) / width), F.floor(us(out_ts) / width) - 1))
                               .alias("__g"), kj.alias("__k"),
                               F.to_json(F.struct(F.col(out_id).alias("id"), *[F.col(p) for p in payload]))
                               .alias("__j"))))
    u = u.withWatermark("__t", delay)

    def decode(js) -> list:
        """One JSON parse for a whole column of JSON texts."""
        return json.loads("[" + ",".join(js) + "]") if len(js) else []

    def step(group, batches, state):
        pending, outs = ([], [])
        if state.exists:
            pending, outs = json.loads(state.get[0]), json.loads(state.get[1])
        if not state.hasTimedOut:
            for pdf in batches:
                is_snap = pdf["__kind"].to_numpy() == 0
                ts, ks, js = pdf["__us"].to_numpy(), pdf["__k"].to_numpy(), pdf["__j"].to_numpy()
                for m, rows in ((is_snap, pending), (~is_snap, outs)):
                    rows.extend(map(list, zip(ts[m].tolist(), ks[m].tolist(), decode(js[m]))))
        wm_ms = state.getCurrentWatermarkMs()
        wm = wm_ms * 1000
        due = [r for r in pending if wm >= r[0] + hi_us]
        keep = [r for r in pending if wm < r[0] + hi_us]
        if due:
            left = pd.DataFrame({"tl": [r[0] + lo_us for r in due], "k": [r[1] for r in due],
                                 "i": range(len(due))}).sort_values("tl", kind="stable")
            if outs:
                # earliest outcome per (key, time) by id, then forward as-of by key
                o_df = pd.DataFrame({"to": [r[0] for r in outs], "k": [r[1] for r in outs],
                                     "oid": [r[2]["id"] for r in outs], "j": range(len(outs))})
                o_df = o_df.sort_values(["k", "to", "oid"]).drop_duplicates(["k", "to"]).sort_values("to")
                m = pd.merge_asof(left, o_df[["to", "k", "j"]], left_on="tl", right_on="to", by="k",
                                  direction="forward", allow_exact_matches=True).sort_values("i")
                ok = m["to"].notna() & (m["to"] < m["tl"] - lo_us + hi_us)
                best = [outs[int(j)] if hit else None for j, hit in zip(m["j"].fillna(-1), ok)]
            else:
                best = [None] * len(due)
            cols = {key: [d["k"] for d in decode([r[1] for r in due])],
                    snap_id: [r[2]["id"] for r in due],
                    snap_ts: pd.to_datetime([r[0] for r in due], unit="us"),
                    f"out_{out_id}": [b[2]["id"] if b else None for b in best],
                    f"out_{out_ts}": pd.to_datetime([b[0] if b else None for b in best], unit="us")}
            for p in payload:
                cols[f"out_{p}"] = [b[2].get(p) if b else None for b in best]
            yield pd.DataFrame(cols, columns=names)
        # outcomes no pending or future snapshot can use any more
        horizon = min([r[0] + lo_us for r in keep] + [wm + lo_us])
        outs = [r for r in outs if r[0] >= horizon]
        if keep or outs:
            state.update((json.dumps(keep), json.dumps(outs)))
            state.setTimeoutTimestamp(max(-(-min([r[0] + hi_us for r in keep] or [wm + hi_us]) // 1000), wm_ms + 1))
        else:
            state.remove()

    return u.groupBy("__bk", "__g").applyInPandasWithState(step, out_schema, state_schema, "append",
                                                          GroupStateTimeout.EventTimeTimeout)
