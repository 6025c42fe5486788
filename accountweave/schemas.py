"""Fixed table schemas: landed CRM objects, landed events, and the event message."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType(), True) for name in names]


# Members of an event message and columns of the landed event table.
IDENTITY_FIELDS = ("sfdc_contact_id", "sfdc_account_id", "anonymous_id", "email", "domain")

EVENT_MESSAGE = T.StructType(
    [
        *_strings("event_id", "event_type", "timestamp"),
        T.StructField("identity_resolution", T.StructType(_strings(*IDENTITY_FIELDS)), True),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType()), True),
    ]
)

LANDED_EVENT = T.StructType(
    [
        *_strings("event_id", "event_type"),
        T.StructField("timestamp", T.TimestampType(), True),
        EVENT_MESSAGE["identity_resolution"],
        EVENT_MESSAGE["attributes"],
        T.StructField("_kafka_offset", T.LongType(), True),
        T.StructField("_kafka_partition", T.IntegerType(), True),
        T.StructField("_ingested_at", T.TimestampType(), True),
        T.StructField("_source_system", T.StringType(), True),
    ]
)

# Columns taken from each CRM object, in landing order.
CRM_COLUMNS = {
    "account": (
        "Id", "Name", "Type", "Phone", "Website", "Industry", "AnnualRevenue", "NumberOfEmployees", "OwnerId",
        "CreatedDate", "SystemModstamp",
    ),
    "contact": (
        "Id", "AccountId", "LastName", "FirstName", "Phone", "Email", "Title", "Department", "OwnerId",
        "CreatedDate", "SystemModstamp",
    ),
    "lead": (
        "Id", "LastName", "FirstName", "Company", "Email", "LeadSource", "Status", "Rating", "OwnerId",
        "IsConverted", "ConvertedAccountId", "ConvertedContactId", "ConvertedOpportunityId", "CreatedDate",
        "SystemModstamp",
    ),
    "opportunity": (
        "Id", "AccountId", "Name", "StageName", "Amount", "Probability", "CloseDate", "Type", "LeadSource",
        "IsClosed", "IsWon", "OwnerId", "CreatedDate", "SystemModstamp",
    ),
    "opportunity_contact_role": (
        "Id", "OpportunityId", "ContactId", "Role", "IsPrimary", "CreatedDate", "SystemModstamp",
    ),
    "user": (
        "Id", "Username", "Name", "Email", "IsActive", "CreatedDate", "SystemModstamp", "UserRole_Name",
    ),
}

_TYPED = {
    "AnnualRevenue": T.DoubleType(),
    "NumberOfEmployees": T.LongType(),
    "Amount": T.DoubleType(),
    "Probability": T.DoubleType(),
    "IsConverted": T.BooleanType(),
    "IsClosed": T.BooleanType(),
    "IsWon": T.BooleanType(),
    "IsPrimary": T.BooleanType(),
    "IsActive": T.BooleanType(),
}

LANDING_COLUMNS = ("_ingested_at", "_source_system", "_batch_id")


def landed_crm(object_name: str) -> T.StructType:
    """Schema of one landed CRM object (used where a table has never been landed)."""
    fields = [T.StructField(c, _TYPED.get(c, T.StringType()), True) for c in CRM_COLUMNS[object_name]]
    landing = [
        T.StructField("_ingested_at", T.TimestampType(), True),
        *_strings("_source_system", "_batch_id"),
    ]
    return T.StructType(fields + landing)


# Columns of the identity map.
IDENTITY = T.StructType(
    [
        *_strings("identity_id", "anonymous_id", "email", "domain", "contact_id", "account_id"),
        *(T.StructField(c, T.TimestampType(), True) for c in ("first_seen_at", "last_seen_at", "updated_at")),
    ]
)

WATERMARK_LOG = T.StructType(
    [
        *_strings("object_name"),
        T.StructField("high_water", T.TimestampType(), True),
        *_strings("batch_id"),
        T.StructField("row_count", T.LongType(), True),
        *_strings("status"),
        T.StructField("updated_at", T.TimestampType(), True),
    ]
)
