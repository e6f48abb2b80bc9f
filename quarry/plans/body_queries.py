"""Queries of the row-wise rewrites and of incremental state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import normalize
from quarry.session import scratch, ship, table
from quarry.sources import html, markdown
from quarry.streaming.incremental import newest_state, sessions, upsert_latest, windowed_counts


def normalized(spark: SparkSession, d: str) -> DataFrame:
    ship(spark)
    bodies = markdown.conversation_bodies(table(spark, d, "conversations"))
    done = normalize.udf(normalize.normalize_body)(F.col("body"))
    return bodies.select("doc_key", done.alias("r")).select("doc_key", F.md5("r.text").alias("digest"), "r.error")


def chunks(spark: SparkSession, d: str) -> DataFrame:
    ship(spark)

    @F.pandas_udf("array<string>")
    def cut(texts):
        return texts.map(lambda t: normalize.split_oversized(t or ""))

    each = table(spark, d, "documents").select("doc_id", F.posexplode(cut("text")).alias("part", "chunk"))
    name = F.when(F.col("part") == 0, F.col("doc_id").cast("string")).otherwise(F.concat_ws("#p", F.col("doc_id").cast("string"), (F.col("part") + 1).cast("string")))
    return each.select("doc_id", F.col("part").cast("long").alias("part"), name.alias("chunk_id"), F.length("chunk").cast("long").alias("n"))


def page_markdown(spark: SparkSession, d: str) -> DataFrame:
    return html.to_markdown(table(spark, d, "pages")).select("page_id", F.md5("body").alias("digest"), F.length("body").cast("long").alias("n"))


def hourly(spark: SparkSession, d: str) -> DataFrame:
    return windowed_counts(table(spark, d, "events"), "ts", "event_type", "1 day")


def streamed_state(spark: SparkSession, d: str) -> DataFrame:
    """The events as a stream, a file a batch, merged into the latest row of each user."""
    path = scratch(spark, "state")
    stream = spark.readStream.schema(table(spark, d, "events").schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/events.parquet*")
    upsert_latest(stream, path, f"{path}-checkpoint", "user_id", "ts", ["event_id", "event_type"]).awaitTermination()
    return newest_state(spark, path, spark.createDataFrame([], "user_id long, ts timestamp, event_id long, event_type string").schema)


def event_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Runs of a user's events with less than six hours between two."""
    return sessions(table(spark, d, "events"), "user_id", "ts", "6 hours", value="value")


QUERIES = {"event_sessions": event_sessions, "normalize_bodies": normalized, "chunk_oversized": chunks, "page_markdown": page_markdown, "windowed_counts": hourly, "stream_latest_state": streamed_state}
ORACLES = {
    "event_sessions": """WITH e AS (SELECT user_id, ts, value, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 6 HOURS, true)::INTEGER AS fresh FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
        g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, fresh DESC ROWS UNBOUNDED PRECEDING) AS s FROM e)
        SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOURS AS stop, count(*) AS events, round(sum(value), 6) AS value FROM g GROUP BY user_id, s""",
    "windowed_counts": "SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "stream_latest_state": "SELECT user_id, ts, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, event_type DESC) AS r FROM events) WHERE r = 1",
}
