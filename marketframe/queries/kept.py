"""Results that streams keep current, over several micro-batches with restarts, and indexes and audits made while writing."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..operators.search import gram_index, search_indexed
from ..plans import bar_states, moments
from ..plans.market import BarSize
from ..session import shared_dir
from ..sources.rawlog import append_audited, read_audited
from ..streaming import changes, keyed, known_keys, outcomes
from ..streaming import streams as s
from .batches import run_in_batches
from .markets import _SIZES
from .registry import ntz, query, r6, rounded
from .series import decay_ctes

DAY = timedelta(days=1)


@query(
    "stream_ema_keyed",
    f"""WITH {decay_ctes(86400)} SELECT i.event_id, i.user_id, round(m, 6) AS PredPrice, round(d.sd, 6) AS PredSD
        FROM inno i JOIN dev d USING (event_id)""",
)
def stream_ema_keyed(t):
    def run(stream, out, checkpoint):
        return keyed.decayed_stream(stream, "ts", DAY, "user_id", "value", "PredPrice", "PredSD", out, checkpoint, "event_id")

    folder = run_in_batches(t, "stream_ema_keyed", run, t.events.select("event_id", "ts", "user_id", "value"))
    return rounded(t.spark.read.parquet(f"{folder}/out").select("event_id", "user_id", "PredPrice", "PredSD"), "PredPrice", "PredSD")


# Half of the event types are known codes. The first error text of the others is that of their first event.
_CODES = [("click", "A click", "note"), ("view", "A view", "")]
_ERRORS = "SELECT event_id, ts, event_type AS ErrorCode, event_type || ' by ' || user_id AS Error FROM events"


@query(
    "stream_error_enrich",
    f"""
    WITH e AS ({_ERRORS}), known(ErrorCode, Message, Note) AS (VALUES ('click', 'A click', 'note'), ('view', 'A view', NULL)),
    learned AS (SELECT ErrorCode, arg_min(Error, (ts, event_id)) AS Message FROM e GROUP BY 1)
    SELECT event_id, ErrorCode, Error, coalesce(k.Message, l.Message) AS ErrorDescription, k.Note
    FROM e LEFT JOIN known k USING (ErrorCode) LEFT JOIN learned l USING (ErrorCode)
    """,
)
def stream_error_enrich(t):
    errors = t.events.select("event_id", "ts", F.col("event_type").alias("ErrorCode"), F.concat("event_type", F.lit(" by "), "user_id").alias("Error"))
    codes = t.spark.createDataFrame(_CODES, "ErrorCode string, Message string, Note string")

    def run(stream, out, checkpoint):
        return outcomes.enrich_errors_stream(stream, codes, ["ts", "event_id"], out, f"{out}-texts", checkpoint)

    folder = run_in_batches(t, "stream_error_enrich", run, errors)
    return t.spark.read.parquet(f"{folder}/out").select("event_id", "ErrorCode", "Error", "ErrorDescription", "Note")


# Every error event of a third of the users cancels the user's flow for three days.
@query(
    "stream_cancelled_flow",
    """
    WITH c AS (SELECT user_id, ts FROM events WHERE event_type = 'error' AND user_id % 3 = 0)
    SELECT event_id, user_id, ts FROM events e
    WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.user_id = e.user_id AND c.ts < e.ts AND c.ts >= e.ts - INTERVAL 3 DAY)
    """,
)
def stream_cancelled_flow(t):
    rows = t.events.select("event_id", "user_id", "ts", "event_type")
    # A last heartbeat lets the watermarks pass all rows.
    beat = rows.agg(F.lit(-1).cast("long").alias("event_id"), F.lit(-1).cast("long").alias("user_id"), (F.max("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts"), F.lit("error").alias("event_type"))

    def run(stream, out, checkpoint):
        stops = stream.filter("event_type = 'error' AND (user_id % 3 = 0 OR user_id = -1)").selectExpr("user_id AS RequestId", "ts AS CancelTime")
        flow = stream.select("event_id", F.col("user_id").alias("RequestId"), "ts")
        return s.start(outcomes.active_stream(flow, stops, "ts", "3 DAYS", "1 hour"), checkpoint, s.write_changes(out))

    folder = run_in_batches(t, "stream_cancelled_flow", run, rows.unionByName(beat), n=6)
    kept = t.spark.read.parquet(f"{folder}/out").filter("event_id >= 0")
    return kept.select("event_id", F.col("RequestId").alias("user_id"), ntz("ts").alias("ts"))


@query("stream_new_keys", "SELECT DISTINCT user_id, event_type FROM events")
def stream_new_keys(t):
    def run(stream, out, checkpoint):
        return known_keys.first_seen_stream(stream, ["user_id", "event_type"], out, f"{out}-known", checkpoint, buckets=16)

    folder = run_in_batches(t, "stream_new_keys", run)
    return t.spark.read.parquet(f"{folder}/out").select("user_id", "event_type")


@query(
    "stream_upsert_compacted",
    """
    SELECT event_id, ts, user_id, event_type, value, props FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
    """,
)
def stream_upsert_compacted(t):
    def run(stream, out, checkpoint):
        return changes.keep_last_rows(stream, "user_id", ["ts", "event_id"], out, checkpoint, buckets=4)

    folder = run_in_batches(t, "stream_upsert_compacted", run, n=10)
    return changes.last_rows(f"{folder}/out", "user_id", ["ts", "event_id"], buckets=4).read(t.spark)


@query(
    "contract_search_indexed",
    """
    SELECT p_partkey, p_name, p_brand, Pattern FROM part, (
      SELECT DISTINCT unnest([upper(substr(p_name, 3, 4)), substr(p_brand, 6), substr(p_name, 2, 2), p_type]) AS Pattern FROM part WHERE p_partkey % 7 = 0)
    WHERE Pattern <> '' AND (contains(lower(p_name), lower(Pattern)) OR contains(lower(p_brand), lower(Pattern)))
    """,
)
def contract_search_indexed(t):
    parts = t.part.select("p_partkey", "p_name", "p_brand")
    asked = F.array(F.upper(F.substring("p_name", 3, 4)), F.expr("substring(p_brand, 6)"), F.substring("p_name", 2, 2), F.col("p_type"))
    patterns = t.part.filter("p_partkey % 7 = 0").select(F.explode(asked).alias("Pattern"))
    columns = ["p_name", "p_brand"]
    return search_indexed(parts, patterns, gram_index(parts, "p_partkey", columns), "p_partkey", columns)


_ALL_BARS = " UNION ALL ".join(
    f"""
    SELECT user_id, {bucket} AS Timestamp, arg_min(value, (ts, event_id)) AS "Open", max(value) AS High, min(value) AS Low, arg_max(value, (ts, event_id)) AS "Close",
           CAST(sum(size) AS DOUBLE) AS Volume, count(*) AS BarCount, round(sum(value * size) / sum(size) + 1e-9, 6) AS WAP, '{size.value}' AS BarSize
    FROM (SELECT *, 1 + event_id % 9 AS size FROM events) GROUP BY 1, 2
    """
    for size, bucket in _SIZES.values()
)
_TICKS = {"ts": "ts", "seq": "event_id", "price": "value", "volume": "size"}


def _ticks(t):
    return t.events.select("event_id", "ts", "user_id", "value", (1 + F.col("event_id") % 9).alias("size"))


@query("bars_rollup_all_sizes", _ALL_BARS)
def bars_rollup_all_sizes(t):
    bars = bar_states.bars_of_sizes(_ticks(t), [size for size, _ in _SIZES.values()], "user_id", **_TICKS)
    return bars.withColumns({"Timestamp": ntz("Timestamp"), "WAP": r6(F.col("WAP") + 1e-9)})


@query(
    "stream_bars_current",
    """
    SELECT user_id, date_trunc('hour', ts) AS Timestamp, arg_min(value, (ts, event_id)) AS "Open", max(value) AS High, min(value) AS Low,
           arg_max(value, (ts, event_id)) AS "Close", CAST(sum(size) AS DOUBLE) AS Volume, count(*) AS BarCount, round(sum(value * size) / sum(size) + 1e-9, 6) AS WAP
    FROM (SELECT *, 1 + event_id % 9 AS size FROM events) GROUP BY 1, 2
    """,
)
def stream_bars_current(t):
    # Every fifth tick comes a long time late: in the batch of its turned-round time.
    def run(stream, out, checkpoint):
        return bar_states.keep_bars_current(stream, BarSize.HOUR_1, "user_id", out, checkpoint, **(_TICKS | {"ts": "at"}))

    ends = F.expr("timestamp '2024-01-31 00:00:00' - (ts - timestamp_ntz '2024-01-01 00:00:00')").cast("timestamp_ntz")
    rows = _ticks(t).withColumnRenamed("ts", "at").withColumn("ts", F.col("at"))
    rows = rows.withColumn("ts", F.when(F.col("event_id") % 5 == 0, ends).otherwise(F.col("ts")))
    folder = run_in_batches(t, "stream_bars_current", run, rows)
    bars = bar_states.finished_bars(bar_states.current_bars(f"{folder}/out", "user_id").read(t.spark))
    return bars.withColumns({"Timestamp": ntz("Timestamp"), "WAP": r6(F.col("WAP") + 1e-9)})


@query(
    "stream_beta",
    """
    SELECT user_id, CASE WHEN var_pop(x) > 0 THEN round(regr_slope(y, x), 6) END AS Beta, round(regr_intercept(y, x), 6) AS Intercept, round(regr_r2(y, x), 6) AS R2
    FROM (SELECT user_id, CASE WHEN event_id % 11 <> 0 THEN value END AS y, CASE WHEN user_id % 10 = 0 THEN 1.0 WHEN event_id % 13 <> 0 THEN 1000 + event_id % 17 END AS x FROM events)
    WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1
    """,
)
def stream_beta(t):
    x = F.when(F.col("user_id") % 10 == 0, 1.0).when(F.col("event_id") % 13 != 0, (1000 + F.col("event_id") % 17).cast("double"))
    pairs = t.events.select("ts", "user_id", F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("Return"), x.alias("BenchmarkReturn"))

    def run(stream, out, checkpoint):
        return moments.keep_betas_current(stream, out, checkpoint, "user_id")

    folder = run_in_batches(t, "stream_beta", run, pairs, n=6)
    betas = moments.regression(moments.current_moments(f"{folder}/out", "user_id").read(t.spark))
    return rounded(betas, "Beta", "Intercept", "R2")


_LOGGED = """SELECT p_partkey, substr(p_name, 1, p_size % 3) || CAST(p_size AS VARCHAR) AS code,
             CASE WHEN p_size % 4 = 0 THEN p_brand WHEN p_size % 5 <> 0 THEN CAST(p_size AS VARCHAR) END AS amount FROM part"""


@query(
    "raw_append_audited",
    f"""
    WITH p AS ({_LOGGED}), a AS (SELECT *, code IS NOT NULL AND TRY_CAST(code AS BIGINT) IS NULL AS bad_code, amount IS NOT NULL AND TRY_CAST(amount AS DOUBLE) IS NULL AS bad_amount FROM p)
    SELECT p_partkey, TRY_CAST(code AS BIGINT) AS code, TRY_CAST(amount AS DOUBLE) AS amount, CAST(NULL AS VARCHAR) AS Reasons,
           (SELECT count(*) FROM a WHERE bad_code) AS CodeMismatches, (SELECT count(*) FROM a WHERE bad_amount) AS AmountMismatches
    FROM a WHERE NOT bad_code AND NOT bad_amount
    UNION ALL
    SELECT p_partkey, NULL, NULL, CASE WHEN bad_code AND bad_amount THEN 'code,amount' WHEN bad_code THEN 'code' ELSE 'amount' END,
           (SELECT count(*) FROM a WHERE bad_code), (SELECT count(*) FROM a WHERE bad_amount)
    FROM a WHERE bad_code OR bad_amount
    """,
)
def raw_append_audited(t):
    path, kinds = shared_dir(t.spark, "raw_append_audited"), {"code": "bigint", "amount": "double"}
    logged = t.part.selectExpr(*(c.strip() for c in ("p_partkey", "substr(p_name, 1, p_size % 3) || CAST(p_size AS STRING) AS code", "CASE WHEN p_size % 4 = 0 THEN p_brand WHEN p_size % 5 <> 0 THEN CAST(p_size AS STRING) END AS amount")))
    bad = append_audited(logged, path, kinds)
    fits, aside = read_audited(t.spark, path, kinds)
    rows = fits.withColumn("Reasons", F.lit(None).cast("string")).unionByName(
        aside.select("p_partkey", F.lit(None).cast("bigint").alias("code"), F.lit(None).cast("double").alias("amount"), F.array_join("__reasons", ",").alias("Reasons"))
    )
    return rows.withColumns({"CodeMismatches": F.lit(bad["code"]).cast("long"), "AmountMismatches": F.lit(bad["amount"]).cast("long")})
