"""Reads: range queries, request tables, look-backs, latest values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from amperline.functions import codes, datetime_ok, name_ok, parse_time
from amperline.operators.thresholds import DEFAULT_BOUNDS, Bounds, evaluate
from amperline.session import stored
from amperline.sources.stores import in_time_range

# Limits of the read requests.
MAX_LIMIT = 1000
DEFAULT_LOOKBACK_MINUTES, MAX_LOOKBACK_MINUTES = 60, 10_080
DEFAULT_HISTORY, MAX_HISTORY = 20, 100
STATUSES = ("RUNNING", "SUCCEEDED", "FAILED", "TIMED_OUT", "ABORTED")
# Blocks are counted within spans of this length.
SPAN_SECONDS = 30 * 86_400
# Later than any block.
LAST_BLOCK = 1 << 40
# Fixed value: appended to an upper text bound so that keys starting with it count.
UPPER_SENTINEL = "￿"


def sensor_range(
    readings: DataFrame,
    sensor: str,
    start: str | None = None,
    end: str | None = None,
    limit: int | None = None,
    ascending: bool = False,
    mode: str = "event_time",
) -> DataFrame:
    """Readings of one sensor, newest first unless ``ascending``.

    Bounds are inclusive.  ``event_time`` compares instants; ``lexical``
    compares the sort key as text, where offsets and missing fractions of a
    second sort by their characters.
    """
    rows = readings.where(F.col("pk") == sensor)
    if mode == "lexical":
        if start is not None:
            rows = rows.where(F.col("sk") >= start)
        if end is not None:
            rows = rows.where(F.col("sk") <= end + UPPER_SENTINEL)
        order = ["sk"]
    elif mode == "event_time":
        rows = in_time_range(rows, start, end)
        order = ["event_ts", "sk"]
    else:
        raise ValueError(f"unknown mode: {mode}")
    rows = rows.orderBy(*[F.col(c).asc() if ascending else F.col(c).desc() for c in order])
    return rows if limit is None else rows.limit(limit)


def coerced_number(text: str) -> Column:
    """A text as a number by the rules of web forms: blank is zero; decimal, or hexadecimal, octal, binary with a prefix."""
    bare = f"regexp_replace({text}, r'^\\s+|\\s+$', '')"
    based = " ".join(
        f"WHEN {bare} RLIKE r'^0[{p}{p.upper()}][{digits}]{{1,15}}$' THEN CAST(conv(substring({bare}, 3), {base}, 10) AS DOUBLE)"
        for p, digits, base in (("x", "0-9a-fA-F", 16), ("o", "0-7", 8), ("b", "01", 2))
    )
    return F.expr(
        f"CASE WHEN {bare} = '' THEN 0D"
        f" WHEN {bare} RLIKE r'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$' THEN try_cast({bare} AS DOUBLE) {based} END"
    )


def check_requests(requests: DataFrame) -> DataFrame:
    """Read requests with their parsed limit and the codes of broken rules."""
    text = F.col("limit_text")
    number = coerced_number("limit_text")
    whole = F.coalesce((number == F.floor(number)) & number.between(1, MAX_LIMIT), F.lit(False))
    def bad_time(column: str) -> Column:
        return F.col(column).isNotNull() & ~datetime_ok(F.col(column))

    return requests.withColumn("limit", F.when(whole, number.cast("int"))).withColumn(
        "errors",
        codes(
            ("sensorId", ~name_ok(F.col("sensorId"))),
            ("from", bad_time("from_time")),
            ("to", bad_time("to_time")),
            ("limit", text.isNotNull() & ~whole),
        ),
    )


def _running_counts(readings: DataFrame, block_seconds: int) -> DataFrame:
    """Rows per time block of each sensor, running within a span of blocks, and the rows of the spans before; stored.

    Spans have a fixed length, so a window sees the blocks of one span or the spans of one sensor, whatever their rows.
    """
    block = F.floor(F.unix_seconds("event_ts") / block_seconds)
    per_block = readings.groupBy("sensorId", block.alias("block")).agg(F.count("*").alias("n"))
    per_block = per_block.withColumn("span", _span("block", block_seconds))
    within = Window.partitionBy("sensorId", "span").orderBy("block")
    running = per_block.withColumn("upto", F.sum("n").over(within))
    spans = running.groupBy("sensorId", "span").agg(F.max("upto").alias("n"))
    along = Window.partitionBy("sensorId").orderBy("span")
    spans = spans.select("sensorId", "span", (F.sum("n").over(along) - F.col("n")).alias("before"), F.sum("n").over(along).alias("after"))
    return stored(running.join(spans, ["sensorId", "span"]).drop("n"), "blocks")


def _span(block: str, block_seconds: int) -> Column:
    return F.floor(F.col(block) / max(1, SPAN_SECONDS // block_seconds))


def _rows_up_to(edges: DataFrame, counts: DataFrame) -> DataFrame:
    """As-of step: for each ``sensorId, span, edge`` the sensor's rows in blocks up to ``edge`` as ``seen``.

    Edges and counts meet by a union in the order of blocks within a span; an edge with no block before it in its span
    takes the end of the last span before, found in the same way among the spans of its sensor.
    """
    no = F.lit(None).cast("bigint")
    blocks = counts.select("sensorId", "span", F.col("block").alias("at"), (F.col("before") + F.col("upto")).alias("rows"), no.alias("edge"))
    asked = edges.select("sensorId", "span", F.col("edge").alias("at"), no.alias("rows"), "edge")
    in_span = Window.partitionBy("sensorId", "span").orderBy("at", F.col("edge").isNotNull())
    met = blocks.unionByName(asked).withColumn("seen", F.last("rows", ignorenulls=True).over(in_span))
    met = met.where("edge IS NOT NULL").drop("rows", "at")
    ends = counts.groupBy("sensorId", "span").agg(F.max("after").alias("rows")).withColumn("asked", F.lit(0))
    spans = ends.unionByName(edges.select("sensorId", "span").distinct().select("*", no.alias("rows"), F.lit(1).alias("asked")))
    earlier = Window.partitionBy("sensorId").orderBy("span").rangeBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("base", F.last("rows", ignorenulls=True).over(earlier)).where("asked = 1")
    seen = F.coalesce("seen", "base", F.lit(0))
    return met.join(spans.select("sensorId", "span", "base"), ["sensorId", "span"]).select("sensorId", "edge", seen.alias("seen"))


def _needed_blocks(requests: DataFrame, readings: DataFrame, block_seconds: int) -> DataFrame:
    """For each request the time blocks that can hold one of its rows.

    Going back from the newest block, a request needs blocks until those that lie wholly inside its range hold ``limit``
    rows; its upper edge block counts as nothing, so no needed block is missed.  With running counts that is a bound:
    a block is needed if more than ``rows before the edge - limit`` rows lie up to its end.  Spans are chosen by the same
    bound first, then the blocks of the chosen spans; each request carries numbers and no list of blocks.
    """
    counts = _running_counts(readings, block_seconds)
    bounded = requests.select(
        "*",
        F.floor(F.unix_seconds("from_ts") / block_seconds).alias("low"),
        F.floor(F.unix_seconds("to_ts") / block_seconds).alias("high"),
    ).withColumn("edge", F.coalesce(F.col("high") - 1, F.lit(LAST_BLOCK)))
    edges = bounded.where("limit IS NOT NULL").select("sensorId", "edge").distinct().withColumn("span", _span("edge", block_seconds))
    reached = bounded.join(_rows_up_to(edges, counts), ["sensorId", "edge"], "left").withColumn("bound", F.col("seen") - F.col("limit"))
    spans = counts.groupBy("sensorId", "span").agg(F.max("after").alias("span_end"))
    chosen = reached.join(spans, "sensorId").where(
        (F.col("low").isNull() | (F.col("span") >= _span("low", block_seconds)))
        & (F.col("high").isNull() | (F.col("span") <= _span("high", block_seconds)))
        & (F.col("limit").isNull() | (F.col("span_end") > F.col("bound")))
    )
    found = chosen.join(counts, ["sensorId", "span"]).where(
        (F.col("low").isNull() | (F.col("block") >= F.col("low")))
        & (F.col("high").isNull() | (F.col("block") <= F.col("high")))
        & (F.col("limit").isNull() | (F.col("before") + F.col("upto") > F.col("bound")))
    )
    return found.select(*requests.columns, "block")


def request_items(
    valid_requests: DataFrame, readings: DataFrame, block_seconds: int = 3600
) -> DataFrame:
    """The newest rows of every request, at most its limit.

    Requests and readings meet on sensor and time block, not on the sensor
    alone, so a busy sensor is spread over its blocks and a request with a limit
    touches a few of them.  Requests without a limit are not ranked.
    """
    timed = valid_requests.select(
        "request_id",
        "sensorId",
        parse_time(F.col("from_time")).alias("from_ts"),
        parse_time(F.col("to_time")).alias("to_ts"),
        # Ranking may drop rows beyond the largest limit early; a larger one is refused and not cut.
        F.expr(f"if(limit > {MAX_LIMIT}, raise_error('limit above {MAX_LIMIT}'), limit)").cast("int").alias("limit"),
    )
    wanted = _needed_blocks(timed, readings, block_seconds)
    cut = readings.withColumn("block", F.floor(F.unix_seconds("event_ts") / block_seconds))
    hits = wanted.join(cut, ["sensorId", "block"]).where(
        (F.col("from_ts").isNull() | (F.col("event_ts") >= F.col("from_ts")))
        & (F.col("to_ts").isNull() | (F.col("event_ts") <= F.col("to_ts")))
    )
    newest = Window.partitionBy("request_id").orderBy(F.col("event_ts").desc(), F.col("sk").desc())
    columns = ["request_id", "sensorId", "sk", "value"]
    ranked = (
        hits.where(F.col("limit").isNotNull())
        .withColumn("rank", F.row_number().over(newest))
        # The constant bound lets Spark drop rows before the shuffle.
        .where(F.col("rank") <= MAX_LIMIT)
        .where(F.col("rank") <= F.col("limit"))
    )
    whole = hits.where(F.col("limit").isNull())
    return ranked.select(*columns).unionAll(whole.select(*columns))


def serve_requests(valid_requests: DataFrame, items: DataFrame) -> DataFrame:
    """One line per request with the number of rows it got, zero included."""
    counts = items.groupBy("request_id").agg(
        F.count("*").alias("item_count"), F.max("sk").alias("newest_sk"), F.min("sk").alias("oldest_sk")
    )
    return (
        valid_requests.select("request_id", "sensorId")
        .join(counts, "request_id", "left")
        .withColumn("item_count", F.coalesce("item_count", F.lit(0)))
    )


def by_type(readings: DataFrame, reading_type: str, start: str, end: str) -> DataFrame:
    """All sensors of one reading type in an event-time range."""
    return in_time_range(readings.where(F.col("readingType") == reading_type), start, end)


def recent_breaches(
    readings: DataFrame,
    as_of: str,
    minutes: int = DEFAULT_LOOKBACK_MINUTES,
    reading_type: str | None = None,
    bounds: Bounds = DEFAULT_BOUNDS,
) -> DataFrame:
    """Breaches of the last minutes before ``as_of``, newest first."""
    if not 1 <= minutes <= MAX_LOOKBACK_MINUTES:
        raise ValueError(f"minutes must be within 1 and {MAX_LOOKBACK_MINUTES}")
    if reading_type is not None and reading_type not in bounds:
        raise ValueError(f"no bounds for reading type {reading_type}")
    start = F.lit(as_of).cast("timestamp") - F.expr(f"make_dt_interval(0, 0, {minutes})")
    rows = readings.where((F.col("event_ts") >= start) & (F.col("event_ts") <= F.lit(as_of).cast("timestamp")))
    if "event_date" in readings.columns:
        rows = rows.where(
            F.col("event_date").between(F.to_date(start), F.to_date(F.lit(as_of).cast("timestamp")))
        )
    if reading_type is not None:
        rows = rows.where(F.col("readingType") == reading_type)
    return (
        evaluate(rows, bounds)
        .where("exceeded")
        .orderBy(F.col("event_ts").desc(), F.col("pk"), F.col("sk"))
    )


def alert_history(
    executions: DataFrame, status: str | None = None, limit: int = DEFAULT_HISTORY
) -> DataFrame:
    """Newest workflow executions, of one status if asked for."""
    if not 1 <= limit <= MAX_HISTORY:
        raise ValueError(f"limit must be within 1 and {MAX_HISTORY}")
    if status is not None and status not in STATUSES:
        raise ValueError(f"unknown status: {status}")
    rows = executions if status is None else executions.where(F.col("status") == status)
    return rows.orderBy(F.col("start_ms").desc(), F.col("name")).limit(limit)


def latest_readings(readings: DataFrame) -> DataFrame:
    """Newest value and last-seen time per sensor and reading type.

    Of several at one time the largest counts.  Each task sends one row per sensor and type.
    """
    return readings.groupBy("sensorId", "readingType").agg(
        F.max(F.struct("event_ts", "value")).alias("last"),
    ).select(
        "sensorId",
        "readingType",
        F.col("last.value").alias("current_value"),
        F.unix_millis("last.event_ts").alias("last_seen_ms"),
    )


def fleet_counts(readings: DataFrame) -> DataFrame:
    """Readings per sensor, with the fleet's total and number of sensors on a last row."""
    per_sensor = readings.groupBy("sensorId").agg(F.count("*").alias("readings"))
    total = per_sensor.agg(
        F.lit("(all)").alias("sensorId"),
        F.coalesce(F.sum("readings"), F.lit(0)).alias("readings"),
        F.count("*").alias("sensors"),
    )
    return per_sensor.withColumn("sensors", F.lit(1).cast("bigint")).unionByName(total)


def below(readings: DataFrame, reading_type: str, limit: float) -> DataFrame:
    return readings.where((F.col("readingType") == reading_type) & (F.col("value") < limit))


def latest(readings: DataFrame, count: int = 10) -> DataFrame:
    """The newest readings of the whole fleet."""
    return readings.orderBy(F.col("event_ts").desc(), F.col("pk"), F.col("sk")).limit(count)
