"""Business rule tables.

Fixed values: these lists must equal the published model rules for results
to match, so they are written out plainly, in their original order.
"""

from __future__ import annotations

# --- Fixed values: food-merchant keyword filter on business categories (16, any match, case-insensitive)
FOOD_KEYWORDS: tuple[str, ...] = (
    "restaurant", "food", "pizza", "burger", "cafe", "coffee", "sushi", "bar",
    "bakery", "diner", "grill", "bistro", "thai", "mexican", "italian", "chinese",
)

# --- Fixed values: food-merchant keyword list used when picking merchants for orders (15)
ORDER_FOOD_KEYWORDS: tuple[str, ...] = (
    "restaurant", "food", "pizza", "burger", "cafe", "sushi", "thai", "mexican",
    "italian", "chinese", "bakery", "diner", "bar", "grill", "bistro",
)

# --- Fixed values: primary cuisine taxonomy, first matching rule wins, else "Other".
# Each rule is (label, keywords that must all occur in the lower-cased text).
CUISINE_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Pizza", ("pizza",)),
    ("Sushi", ("sushi",)),
    ("Thai", ("thai",)),
    ("Mexican", ("mexican",)),
    ("Italian", ("italian",)),
    ("Chinese", ("chinese",)),
    ("Burgers", ("burger",)),
    ("Sandwiches", ("sandwich",)),
    ("Coffee & Tea", ("coffee",)),
    ("Coffee & Tea", ("cafe",)),
    ("Bakery", ("bakery",)),
    ("Bars & Grills", ("bar", "food")),
    ("American (Traditional)", ("diner",)),
    ("American (New)", ("american",)),
    ("Seafood", ("seafood",)),
    ("Indian", ("indian",)),
    ("Korean", ("korean",)),
    ("Vietnamese", ("vietnamese",)),
    ("Mediterranean", ("mediterranean",)),
)
CUISINE_DEFAULT = "Other"

# --- Fixed values: the shorter development taxonomy (12 arms), unmatched text passes through unchanged
DEV_CUISINE_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Pizza", ("pizza",)),
    ("Sushi", ("sushi",)),
    ("Thai", ("thai",)),
    ("Mexican", ("mexican",)),
    ("Italian", ("italian",)),
    ("Chinese", ("chinese",)),
    ("Burgers", ("burger",)),
    ("Coffee & Tea", ("coffee",)),
    ("Coffee & Tea", ("cafe",)),
    ("Bakery", ("bakery",)),
    ("American (New)", ("american",)),
    ("Seafood", ("seafood",)),
)

# --- Fixed values: performance tier labels (tier number -> label)
TIER_LABELS: tuple[tuple[int, str], ...] = (
    (5, "Elite"),
    (4, "Strong"),
    (3, "Average"),
    (2, "Below Average"),
    (1, "Low"),
)

# --- Fixed values: composite score weights (stars, review velocity, check-ins) and star scale
SCORE_WEIGHT_STARS = 0.40
SCORE_WEIGHT_VELOCITY = 0.35
SCORE_WEIGHT_CHECKINS = 0.25
STAR_SCALE = 5.0
N_TIERS = 5

# --- Fixed values: accepted half-star ratings and order statuses
HALF_STARS: tuple[float, ...] = (1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0)
ORDER_STATUSES: tuple[str, ...] = ("delivered", "cancelled")
SENTIMENTS: tuple[str, ...] = ("positive", "neutral", "negative")

# --- Fixed values: review floor of the production staging model, retention horizon
REVIEW_MIN_DATE = "2015-01-01"
RETENTION_MAX_MONTHS = 24

# --- Fixed values: order simulator constants used by the order rules
MIN_ACTUAL_DELIVERY_MIN = 10
ON_TIME_SLACK_MIN = 5
ORDER_MIN_USD = 8.00
ORDER_MAX_USD = 120.00

# --- Fixed values: weekday order for reports (Monday first) and tier order (Elite first)
WEEKDAYS: tuple[str, ...] = (
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
)

# --- Fixed values: dashboard thresholds
FULFILLMENT_LOW = 0.90
FULFILLMENT_HIGH = 0.96
FULFILLMENT_TARGET = 0.95
RETENTION_REFERENCE_PCT = 20.0
DELIVERY_BIN_MIN = 2

# --- Fixed values: NULL tokens accepted by the mart CSV load contract
CSV_NULL_TOKENS: tuple[str, ...] = ("", "None", "NULL")


# Rules for the driver's test tables (not part of the published models): the
# merchant "categories" text there is a part name such as "red widget".
PART_KEYWORDS: tuple[str, ...] = ("ring", "bolt", "plate", "gear", "widget", "gizmo", "red")
PART_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Red anvil", ("red", "anvil")),
    ("Jewelry", ("ring",)),
    ("Metal", ("bolt",)),
    ("Metal", ("rod",)),
    ("Metal", ("plate",)),
    ("Parts", ("gear",)),
    ("Parts", ("widget",)),
    ("Parts", ("gizmo",)),
)
PART_DEV_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Jewelry", ("ring",)),
    ("Metal", ("bolt",)),
    ("Metal", ("plate",)),
    ("Parts", ("gear",)),
    ("Parts", ("widget",)),
)
