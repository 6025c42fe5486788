"""Event contract: the rules a raw JSON message must keep, as column predicates (batch and streaming alike)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountweave.functions.scoring import EVENT_WEIGHTS
from accountweave.schemas import EVENT_MESSAGE, IDENTITY_FIELDS

# Fixed value: shape of an event id.
EVENT_ID_PATTERN = "^evt_[a-zA-Z0-9_-]+$"
# Fixed value: RFC 3339 date-time.
DATE_TIME_PATTERN = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"

REQUIRED = tuple(EVENT_MESSAGE.fieldNames())


def _json_type(value: Column) -> Column:
    """Type name of a variant: STRING, VOID (JSON null), BIGINT, OBJECT<...>, ARRAY<...>, ..."""
    return F.schema_of_variant(value)


def _is_text(value: Column) -> Column:
    return F.coalesce(_json_type(value) == "STRING", F.lit(False))


def _is_object(value: Column) -> Column:
    return F.coalesce(_json_type(value).startswith("OBJECT"), F.lit(False))


def with_violations(df: DataFrame, payload: str = "json_payload", check_format: bool = True) -> DataFrame:
    """Add ``violations``: codes of the broken rules in a fixed order, empty for a valid message.

    The text is parsed once, into a map of variants, which keeps the JSON type of each member. ``check_format``
    covers the date-time format of ``timestamp``, which plain JSON Schema validation treats as a note only.
    """
    parsed = df.withColumn("_m", F.from_json(payload, "map<string,variant>"))
    member = {name: F.col("_m")[name] for name in REQUIRED}
    keys = F.map_keys("_m")
    present = {name: F.array_contains(keys, name) for name in REQUIRED}
    identity = F.try_variant_get(member["identity_resolution"], "$", "map<string,variant>")

    def text_of(name: str) -> Column:
        return F.try_variant_get(member[name], "$", "string")

    rules: list[tuple[Column, str]] = [(F.col("_m").isNull(), "malformed")]
    rules += [(~present[name], f"missing_{name}") for name in REQUIRED]
    rules += [
        (
            present["event_id"] & ~(_is_text(member["event_id"]) & text_of("event_id").rlike(EVENT_ID_PATTERN)),
            "event_id",
        ),
        (
            present["event_type"] & ~(_is_text(member["event_type"]) & text_of("event_type").isin(*EVENT_WEIGHTS)),
            "event_type",
        ),
    ]
    well_timed = _is_text(member["timestamp"])
    if check_format:
        well_timed = well_timed & (
            text_of("timestamp").rlike(DATE_TIME_PATTERN) & text_of("timestamp").try_cast("timestamp").isNotNull()
        )
    rules += [
        (present["timestamp"] & ~well_timed, "timestamp"),
        (present["identity_resolution"] & ~_is_object(member["identity_resolution"]), "identity_resolution"),
        (
            F.size(F.array_except(F.map_keys(identity), F.array(*map(F.lit, IDENTITY_FIELDS)))) > 0,
            "identity_resolution_extra",
        ),
        (
            F.exists(F.map_values(identity), lambda v: ~_json_type(v).isin("STRING", "VOID")),
            "identity_resolution_value",
        ),
        (present["attributes"] & ~_is_object(member["attributes"]), "attributes"),
        (F.size(F.array_except(keys, F.array(*map(F.lit, REQUIRED)))) > 0, "extra"),
    ]
    codes = F.array_compact(F.array(*(F.when(broken, code) for broken, code in rules)))
    return parsed.withColumn("violations", codes).drop("_m")


def split_by_contract(
    df: DataFrame, payload: str = "json_payload", check_format: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(valid messages, messages for quarantine with their ``violations``)."""
    checked = with_violations(df, payload, check_format)
    return checked.where(F.size("violations") == 0).drop("violations"), checked.where(F.size("violations") > 0)
