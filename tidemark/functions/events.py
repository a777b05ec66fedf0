"""Column expressions of the event pipeline: typed JSON access, ids, metadata and text."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Fixed fields of the four event variants: required, then optional.
TEXT, WHOLE = "STRING", "BIGINT"
EVENT_FIELDS: dict[str, tuple[dict[str, str], dict[str, str]]] = {
    "chat": (
        {"user_id": TEXT, "room_id": TEXT, "timestamp": WHOLE},
        {
            "journey_id": TEXT, "message": TEXT, "message_type": TEXT, "chat_type": TEXT, "message_id": TEXT,
            "created_at": WHOLE, "updated_at": WHOLE,
        },
    ),
    "join": (
        {"user_id": TEXT, "room_id": TEXT, "timestamp": WHOLE},
        {"room_action": TEXT, "created_at": WHOLE, "updated_at": WHOLE},
    ),
    "leave": (
        {"user_id": TEXT, "room_id": TEXT, "timestamp": WHOLE},
        {"room_action": TEXT, "created_at": WHOLE, "updated_at": WHOLE},
    ),
    "reaction": (
        {"user_id": TEXT, "room_id": TEXT, "message_id": TEXT, "emoji": TEXT, "timestamp": WHOLE},
        {"target_user_id": TEXT, "created_at": WHOLE, "updated_at": WHOLE},
    ),
}
NORMALIZED_REQUIRED = {
    "event_type": TEXT, "user_id": TEXT, "room_id": TEXT, "timestamp": WHOLE, "payload": TEXT, "metadata_json": TEXT,
    "event_id": TEXT, "server_timestamp": WHOLE,
}
NORMALIZED_OPTIONAL = {"journey_id": TEXT}


def field_types(variant: Column) -> Column:
    """Map of top-level field to type name ('VOID' for an explicit null); NULL unless the body is an object."""
    return F.transform_values(variant.try_cast("map<string, variant>"), lambda _, v: F.schema_of_variant(v))


def typed_fields(body: Column, fields: dict[str, str]) -> Column:
    """The named fields of a JSON body as one typed struct, in one parse."""
    kinds = ", ".join(f"`{name}` {'bigint' if kind == WHOLE else 'string'}" for name, kind in fields.items())
    return F.from_json(body, kinds)


def shape_of(variant: Column) -> Column:
    """The body's fields and types as text (``OBJECT<a: STRING, b: BIGINT>``); NULL for malformed JSON."""
    return F.schema_of_variant(variant)


def plainly_valid(required: dict[str, str], optional: dict[str, str]) -> str:
    """Pattern of the shapes that are valid at a glance: every required field there, every known one of its type,
    nothing nested. Shapes that don't match are looked at field by field."""
    present = "".join(f"(?=.*[< ]{name}: {kind}[,>])" for name, kind in required.items())
    known = "|".join(f"{name}: {kind}" for name, kind in required.items())
    known = "|".join([known, *[f"{name}: (?:{kind}|VOID)" for name, kind in optional.items()]])
    names = "|".join([*required, *optional])
    other = rf"(?!(?:{names}):)\w+: \w+(?:\(\d+,\d+\))?"
    return rf"^{present}OBJECT<(?:(?:{known}|{other})(?:, |(?=>$)))+>$"


def usual_shapes(required: dict[str, str], optional: dict[str, str]) -> list[str]:
    """The shapes of bodies with all required fields and any of the optional ones, and no others."""
    shapes = []
    for size in range(len(optional) + 1):
        for more in itertools.combinations(optional, size):
            fields = {**required, **{name: optional[name] for name in more}}
            shapes.append("OBJECT<" + ", ".join(f"{name}: {fields[name]}" for name in sorted(fields)) + ">")
    return shapes


def _literal_map(fields: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in fields.items() for x in pair])


def missing_fields(types: Column, required: Column) -> Column:
    """The required names that are absent or null."""
    return F.filter(required, lambda f: F.coalesce(F.element_at(types, f), F.lit("VOID")) == "VOID")


def wrong_fields(types: Column, kinds: Column) -> Column:
    """The names present with another type than ``kinds`` (map of name to type) asks for."""
    return F.filter(F.map_keys(kinds), lambda f: ~F.element_at(types, f).isin("VOID") & (F.element_at(types, f) != F.element_at(kinds, f)))


def required_of(tag: Column) -> Column:
    """Array of the required fields of an event variant."""
    table = F.create_map(*[c for n, (req, _) in EVENT_FIELDS.items() for c in (F.lit(n), F.array(*[F.lit(f) for f in req]))])
    return F.element_at(table, tag)


def kinds_of(tag: Column) -> Column:
    """Map of every field of an event variant to its type."""
    table = F.create_map(*[c for n, (req, opt) in EVENT_FIELDS.items() for c in (F.lit(n), _literal_map(req | opt))])
    return F.element_at(table, tag)


def normalized_required() -> Column:
    return F.array(*[F.lit(f) for f in NORMALIZED_REQUIRED])


def normalized_kinds() -> Column:
    return _literal_map(NORMALIZED_REQUIRED | NORMALIZED_OPTIONAL)


def evaluate_once(df: DataFrame, **values: Column) -> DataFrame:
    """Add columns computed once per row.

    Written as a one-element generator: the optimizer does not inline the
    values into the many expressions that use them, nor push filters below it.
    """
    row = F.struct(*[value.alias(name) for name, value in values.items()])
    return df.select("*", F.inline(F.array(row)))


def json_object(**fields: Column) -> Column:
    """JSON text with sorted keys that keeps nulls."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def content_id(columns: Sequence[Column]) -> Column:
    """Id derived from content, in UUID layout: a retried event keeps its id, so writes stay idempotent.

    Each value is length-prefixed, so moving text between fields changes the id.
    """
    tagged = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in (c.cast("string") for c in columns)]
    digest = F.sha2(F.concat(*tagged), 256)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in cuts])


def random_id() -> Column:
    """Random UUID, one per event."""
    return F.uuid()


def server_millis() -> Column:
    return F.unix_millis(F.current_timestamp())
