"""Event stream: parse, reject, normalise, publish format, message store views and metrics.

Every function is stateless per row unless it says otherwise, and works on
batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import events as E
from tidemark.operators.distribution import exact_quantile
from tidemark.operators.keyed import latest_by_key
from tidemark.operators.ordering import latest_per_group
from tidemark.session import cut_lineage
from tidemark.schemas import MESSAGES, MESSAGES_KEY, NORMALIZED_EVENT

_ALL_FIELDS = {f: t for required, optional in E.EVENT_FIELDS.values() for f, t in (required | optional).items()}


def _field_error(types: Column, required: Column, kinds: Column) -> Column:
    missing, wrong = E.missing_fields(types, required), E.wrong_fields(types, kinds)
    return F.when(F.size(missing) > 0, F.concat(F.lit("missing_field:"), F.array_join(missing, ","))).when(
        F.size(wrong) > 0, F.concat(F.lit("wrong_type:"), F.array_join(wrong, ","))
    )


def _opened(raw: DataFrame, body: str, passed: list[str]) -> DataFrame:
    """The passed columns with the body ``_v`` as a variant and its shape ``_s``, each computed once per row."""
    parsed = E.evaluate_once(raw.select(*passed), _v=F.try_parse_json(F.col(body)))
    return E.evaluate_once(parsed, _s=E.shape_of(F.col("_v")))


def _plain(shape: Column, required: dict[str, str], optional: dict[str, str]) -> Column:
    """Whether a shape is valid as a whole: one of the usual ones, or like them with nulls and unknown fields."""
    return shape.isin(*E.usual_shapes(required, optional)) | shape.rlike(E.plainly_valid(required, optional))


def parse_events(raw: DataFrame, body: str = "value") -> DataFrame:
    """Parse JSON bodies as the tagged union: one column per field and ``error``, NULL for valid rows.

    Strict about types: a string where a whole number belongs (or the other
    way round) is an error; unknown keys are ignored. Most bodies are accepted
    by the text of their shape; only the others are looked at field by field.
    The fields come from one typed parse, which is left out where none is used.
    """
    v, shape, tag = F.col("_v"), F.col("_s"), F.col("_tag")
    passed = [c for c in raw.columns if c not in _ALL_FIELDS and c != "event_type"]
    opened = _opened(raw, body, passed).withColumn("_tag", F.try_variant_get(v, "$.event_type", "string"))
    plain = F.lit(False)
    for name, (required, optional) in E.EVENT_FIELDS.items():
        plain = plain | ((tag == name) & _plain(shape, {"event_type": E.TEXT} | required, optional))
    types = E.field_types(v)
    tag_type = F.element_at(types, F.lit("event_type"))
    error = (
        F.when(plain, None)
        .when(v.isNull(), "malformed_json")
        .when(types.isNull(), "not_an_object")
        .when(F.coalesce(tag_type, F.lit("VOID")) == "VOID", "missing_field:event_type")
        .when(tag_type != E.TEXT, "wrong_type:event_type")
        .when(~tag.isin(*E.EVENT_FIELDS), "unknown_event_type")
        .otherwise(_field_error(types, E.required_of(tag), E.kinds_of(tag)))
    )
    own = {f: [n for n, (req, opt) in E.EVENT_FIELDS.items() if f in req | opt] for f in _ALL_FIELDS}
    checked = opened.select(*passed, "_s", "_tag", error.alias("error"))
    text = F.col("error").isNull() | shape.rlike(r"^OBJECT<(?:.*, )?event_type: STRING[,>]")
    tagged = checked.select(*passed, F.when(text, tag).alias("event_type"), "error")
    typed = tagged.withColumn("_f", E.typed_fields(F.col(body), _ALL_FIELDS))
    fields = [F.when(F.col("event_type").isin(*own[f]), F.col(f"_f.{f}")).alias(f) for f in _ALL_FIELDS]
    return typed.select(*passed, "event_type", *fields, "error")


def valid_events(parsed: DataFrame, body: str = "value") -> DataFrame:
    return parsed.filter(F.col("error").isNull()).drop("error", body)


def rejected_events(parsed: DataFrame, body: str = "value") -> DataFrame:
    """Bad-record path: raw text and reason of every row that is not a valid event."""
    return parsed.filter(F.col("error").isNotNull()).select(F.col(body).alias("raw"), "error")


def normalize_events(events: DataFrame, server_time: Column | None = None, ids: str = "content") -> DataFrame:
    """The nine-field normalised event of each variant.

    ``ids='content'`` derives the id from the event so that a replay repeats
    it; ``ids='uuid'`` draws a random one. ``server_time`` is epoch millis.
    """
    tag = F.col("event_type")
    chat_meta = E.json_object(
        message_type=F.col("message_type"), chat_type=F.col("chat_type"), message_id=F.col("message_id")
    )
    reaction_meta = E.json_object(message_id=F.col("message_id"), target_user_id=F.col("target_user_id"))
    shaped = events.select(
        "event_type",
        "user_id",
        "room_id",
        F.when(tag == "chat", F.col("journey_id")).alias("journey_id"),
        "timestamp",
        F.when(tag == "chat", F.coalesce("message", F.lit("")))
        .when(tag == "reaction", F.col("emoji"))
        .otherwise("")
        .alias("payload"),
        F.when(tag == "chat", chat_meta).when(tag == "reaction", reaction_meta).otherwise("{}").alias("metadata_json"),
        (E.server_millis() if server_time is None else server_time).cast("bigint").alias("server_timestamp"),
    )
    identity = ["event_type", "user_id", "room_id", "journey_id", "timestamp", "payload", "metadata_json"]
    if ids == "content":
        event_id = E.content_id([F.col(c) for c in identity])
    elif ids == "uuid":
        event_id = E.random_id()
    else:
        raise ValueError(f"unknown id strategy: {ids}")
    return shaped.withColumn("event_id", event_id).select(*NORMALIZED_EVENT.names)


def to_topic_records(events: DataFrame) -> DataFrame:
    """Topic records: key is the event type, value the JSON of all nine fields with nulls kept."""
    body = F.to_json(F.struct(*NORMALIZED_EVENT.names), {"ignoreNullFields": "false"})
    return events.select(F.col("event_type").alias("key"), body.alias("value"))


def parse_normalized(records: DataFrame, body: str = "value") -> DataFrame:
    """Read normalised events back; ``error`` is set where a required field is missing or mistyped."""
    fields = E.NORMALIZED_REQUIRED | E.NORMALIZED_OPTIONAL
    v, types = F.col("_v"), E.field_types(F.col("_v"))
    error = (
        F.when(_plain(F.col("_s"), E.NORMALIZED_REQUIRED, E.NORMALIZED_OPTIONAL), None)
        .when(v.isNull(), "malformed_json")
        .when(types.isNull(), "not_an_object")
        .otherwise(_field_error(types, E.normalized_required(), E.normalized_kinds()))
    )
    passed = [c for c in records.columns if c not in fields]
    checked = _opened(records, body, passed).select(*passed, error.alias("error"))
    typed = checked.withColumn("_f", E.typed_fields(F.col(body), fields))
    return typed.select(*passed, *[F.col(f"_f.{f}").alias(f) for f in NORMALIZED_EVENT.names], "error")


def reply(events: DataFrame, topic: str) -> DataFrame:
    """The acknowledgement of each delivered event."""
    return events.select(
        F.lit(True).alias("ok"), F.lit("delivered").alias("status"), "event_id", F.lit(topic).alias("topic")
    )


def failure_reply(parsed: DataFrame, topic: str) -> DataFrame:
    """The answer to each event that was not delivered: no id, and the reason as its status."""
    return parsed.filter(F.col("error").isNotNull()).select(
        F.lit(False).alias("ok"), F.col("error").alias("status"), F.lit(None).cast("string").alias("event_id"), F.lit(topic).alias("topic")
    )


# ---- message store ------------------------------------------------------------------------------


def message_rows(events: DataFrame) -> DataFrame:
    """The eight stored columns of the message table."""
    return events.select(*MESSAGES.names)


def latest_messages(rows: DataFrame) -> DataFrame:
    """Last write per message key wins."""
    return latest_by_key(message_rows(rows), MESSAGES_KEY, ["server_timestamp"])


def message_view(rows: DataFrame, *also: str) -> DataFrame:
    """Stored rows in the modelled columns: text, replied-to id and emoji apart. ``also`` names further columns to keep."""
    tag = F.col("event_type")
    return rows.select(
        "room_id",
        "timestamp",
        "event_id",
        "event_type",
        "user_id",
        F.when(tag == "chat", F.col("payload")).alias("message"),
        F.get_json_object("metadata_json", "$.message_id").alias("message_id"),
        F.when(tag == "reaction", F.col("payload")).alias("emoji"),
        *also,
    )


def message_table_view(rows: DataFrame) -> DataFrame:
    """The modelled message table: one row per key as last written, ``created_at`` and ``updated_at`` its first and last server stamp."""
    values = [c for c in MESSAGES.names if c not in MESSAGES_KEY]
    order = F.struct("server_timestamp", *[c for c in values if c != "server_timestamp"])
    kept = message_rows(rows).groupBy(*MESSAGES_KEY).agg(
        F.max_by(F.struct(*values), order).alias("_last"), F.min("server_timestamp").alias("created_at"), F.max("server_timestamp").alias("updated_at")
    )
    stored = kept.select(*MESSAGES_KEY, "_last.*", "created_at", "updated_at")
    return message_view(stored, "created_at", "updated_at")


def recent_messages(rows: DataFrame, n: int, room: str = "room_id", time: str = "timestamp", tie: str = "event_id") -> DataFrame:
    """The newest ``n`` messages of each room."""
    return latest_per_group(rows, [room], [F.desc(time), F.desc(tie)], n)


def room_members(events: DataFrame) -> DataFrame:
    """Current members per room: users whose last join/leave is a join (on a tie the leave counts)."""
    moves = events.filter(F.col("event_type").isin("join", "leave")).select("room_id", "user_id", "timestamp", "event_type")
    # 'leave' sorts after 'join', so the greatest (timestamp, event_type) is the deciding move.
    last = latest_by_key(moves, ["room_id", "user_id"], ["timestamp", "event_type"])
    return last.filter(F.col("event_type") == "join").select(
        "room_id", "user_id", F.col("timestamp").alias("joined_at"), F.col("timestamp").alias("updated_at")
    )


def user_rooms(members: DataFrame) -> DataFrame:
    """The same membership keyed by user."""
    return members.select("user_id", "room_id", "joined_at", "updated_at")


def rooms(events: DataFrame) -> DataFrame:
    """Room metadata: first and last event time, and the type of the latest chat (NULL before any)."""
    typed = F.when(F.col("event_type") == "chat", F.col("chat_type"))
    return events.groupBy("room_id").agg(
        F.col("room_id").alias("name"),
        F.max_by(typed, F.when(typed.isNotNull(), F.struct("timestamp", typed))).alias("room_type"),
        F.min("timestamp").alias("created_at"),
        F.max("timestamp").alias("updated_at"),
    )


# ---- metrics ------------------------------------------------------------------------------------


def throughput(parsed: DataFrame, seconds: Column) -> DataFrame:
    """Totals, errors and events per second over the observed span; ``seconds`` is each row's time."""
    span = F.max(seconds) - F.min(seconds)
    return parsed.agg(
        F.count_if(F.col("error").isNull()).alias("total_events"),
        F.count_if(F.col("error").isNotNull()).alias("errors"),
        span.alias("uptime_seconds"),
        (F.count_if(F.col("error").isNull()) / F.greatest(span, F.lit(1.0))).alias("events_per_second"),
    )


def throughput_by_interval(parsed: DataFrame, seconds: Column, every: int = 5) -> DataFrame:
    """The same counters per reporting interval of ``every`` seconds."""
    slot = (F.floor(seconds / every) * every).cast("bigint")
    return parsed.groupBy(slot.alias("interval_start")).agg(
        F.count_if(F.col("error").isNull()).alias("n_events"), F.count_if(F.col("error").isNotNull()).alias("n_errors")
    )


def ingest_latency(events: DataFrame) -> DataFrame:
    """Milliseconds between event time (seconds) and server stamp (millis)."""
    return events.withColumn("latency_ms", F.col("server_timestamp") - F.col("timestamp") * 1000)


def latency_by_window(events: DataFrame, seconds: int, q: float = 0.95) -> DataFrame:
    """The latency summary of each time window of so many seconds, named by its start."""
    start = (F.floor(F.col("timestamp") / seconds) * seconds).cast("bigint")
    return latency_summary(events.withColumn("window_start", start), "window_start", q)


def latency_summary(events: DataFrame, by: str = "event_type", q: float = 0.95) -> DataFrame:
    """Mean, extremes and exact upper quantile of the ingest latency."""
    # Written once: the quantile reads its input several times, and parsing is what costs.
    timed = cut_lineage(ingest_latency(events).select(by, F.col("latency_ms").cast("double").alias("latency_ms")), "latency")
    spread = timed.groupBy(by).agg(
        F.count("*").alias("n"),
        F.avg("latency_ms").alias("mean_ms"),
        F.min("latency_ms").alias("min_ms"),
        F.max("latency_ms").alias("max_ms"),
    )
    return spread.join(exact_quantile(timed, [by], "latency_ms", q, into="upper_ms"), by)
