"""Schemas of the tables the jobs exchange."""

from pyspark.sql import types as T

STRING_MAP = T.MapType(T.StringType(), T.StringType())

UTM = T.StructType([T.StructField(n, T.StringType()) for n in
                    ("utmsource", "utmmedium", "utmcampaign", "utmterm", "utmcontent")])

_EVENT_TEXT = (
    "schema_version", "event_id", "tenant_id", "observer_id", "datetime", "metric", "visid", "refvisid", "mediahost",
    "tpurl", "tprefurl", "tprefdomain", "tpname", "refhashedphone", "refhashedemail", "fgp", "sessionid", "language",
    "platform", "user_agent", "app_version", "device", "open_in_app", "purchase_flow", "invoice_number",
)

# Fields whose JSON type decides about acceptance; they are parsed as variants so that the type is kept.
TYPED_FIELDS = ("tenant_id", "visid", "metric")

# The known part of a tracking document; unknown fields are allowed and ignored.
TRACKING_EVENT = T.StructType(
    [T.StructField(n, T.VariantType() if n in TYPED_FIELDS else T.StringType()) for n in _EVENT_TEXT]
    + [
        T.StructField("event_date", T.DoubleType()),
        T.StructField("unix_timestamp", T.DoubleType()),
        T.StructField("is_in_app_browser", T.BooleanType()),
        T.StructField("utmdata", UTM),
        T.StructField("event_payload", STRING_MAP),
        T.StructField("profile_traits", STRING_MAP),
        T.StructField("_corrupt", T.StringType()),
    ]
)

# Staging columns filled from a tracking document, in table order.
RAW_TEXT_COLUMNS = (
    "tenant_id", "source_system", "email", "phone_number", "web_visitor_id", "crm_contact_id", "crm_source_id",
    "social_user_id", "first_name", "last_name", "gender", "date_of_birth", "address_line1", "address_line2", "city",
    "state", "zip_code", "country", "latitude", "longitude", "preferred_language", "preferred_currency",
    "last_seen_at", "last_seen_observer_id", "last_seen_touchpoint_id", "last_seen_touchpoint_url",
    "last_known_channel",
)

RAW_TYPES = {"date_of_birth": "date", "latitude": "double", "longitude": "double", "last_seen_at": "timestamp_ntz"}

# Longest value a staging column may hold.
RAW_LENGTHS = {
    "tenant_id": 36, "source_system": 100, "phone_number": 50, "web_visitor_id": 36, "first_name": 255,
    "last_name": 255, "gender": 20, "zip_code": 10, "country": 100,
}
