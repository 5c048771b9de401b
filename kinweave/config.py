"""Match rules and survivorship policies as plain data."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    """One identity rule; the smallest ``id`` has the highest priority.

    ``kind`` says where the identifier lives on a golden record: a scalar ``column``, a member of an ``array``, or a
    value of a ``map`` keyed by source system.
    """

    id: int
    attribute: str
    matching_rule: str = "exact"
    threshold: float | None = None
    consolidation_rule: str = "non_null"
    kind: str = "column"
    ignore_case: bool = False


# The identity attributes that are active by default.
DEFAULT_RULES = (
    Rule(1, "email", consolidation_rule="non_null", ignore_case=True),
    Rule(2, "phone_number", consolidation_rule="non_null"),
    Rule(3, "social_user_id", consolidation_rule="prefer_master", kind="map"),
    Rule(4, "web_visitor_id", consolidation_rule="most_recent", kind="array"),
    Rule(5, "crm_source_id", consolidation_rule="prefer_master", kind="map"),
)

# Survivorship policy per golden-record column.
PREFER_RAW = (
    "first_name", "last_name", "gender", "date_of_birth",
    "address_line1", "address_line2", "city", "state", "zip_code", "country", "latitude", "longitude",
    "preferred_language", "preferred_currency",
)
PREFER_MASTER = ("email", "phone_number")
LATEST_TOGETHER = (
    "last_seen_observer_id", "last_seen_touchpoint_id", "last_seen_touchpoint_url", "last_known_channel",
)

# Record states.
RAW_PROCESSED, RAW_IN_PROGRESS, RAW_PENDING, RAW_DEACTIVATED, DELETE = 3, 2, 1, 0, -1
MASTER_TO_NOTIFY, MASTER_ACTIVE = 10, 1

# Event names and their class.
EVENT_CLASSES = {
    "ad-impression": "view", "page-view": "view", "accept-tracking": "view", "engaged-session": "view",
    "content-view": "view", "item-view": "view",
    "like": "action", "search": "action", "click-details": "action", "play-video": "action",
    "submit-contact": "action", "file-download": "action", "register-account": "action", "user-login": "action",
    "short-link-click": "action", "ask-question": "action", "product-trial": "action",
    "purchase": "conversion",
}

# Mobile prefixes of the default phone region.
VN_MOBILE_PREFIXES = (
    "096", "097", "098", "032", "033", "034", "035", "036", "037", "038", "039",
    "091", "094", "081", "082", "083", "084", "085", "088",
    "090", "093", "070", "076", "077", "078", "079",
    "092", "056", "058",
    "099", "059",
)
