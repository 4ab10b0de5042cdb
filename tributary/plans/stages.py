"""The purchase funnel."""

# Events that mark a stage, from the top of the funnel to the bottom.
# A stage's number is its position, counted from 1.
STAGES = (
    "session_start",
    "page_view",
    "view_item",
    "add_to_cart",
    "begin_checkout",
    "add_payment_info",
    "purchase",
)
UNKNOWN_STAGE = "unknown"

# Names of the flags "reached this stage and the one before it".
PROGRESS_FLAGS = {
    "page_view": "progressed_to_page_view",
    "view_item": "progressed_to_view_item",
    "add_to_cart": "progressed_to_add_to_cart",
    "begin_checkout": "progressed_to_checkout",
    "add_payment_info": "progressed_to_payment",
    "purchase": "progressed_to_purchase",
}

# Names of the session counts per stage in the summary.
STAGE_COUNTS = {
    "page_view": "sessions_with_page_view",
    "view_item": "sessions_with_view_item",
    "add_to_cart": "sessions_with_add_to_cart",
    "begin_checkout": "sessions_with_checkout",
    "add_payment_info": "sessions_with_payment",
    "purchase": "sessions_with_purchase",
}

# Step rates, as (name, count reached, count before).
STEP_RATES = (
    ("rate_session_to_page_view", "sessions_with_page_view", "total_sessions"),
    ("rate_page_view_to_view_item", "sessions_with_view_item", "sessions_with_page_view"),
    ("rate_view_item_to_add_to_cart", "sessions_with_add_to_cart", "sessions_with_view_item"),
    ("rate_cart_to_checkout", "sessions_with_checkout", "sessions_with_add_to_cart"),
    ("rate_checkout_to_payment", "sessions_with_payment", "sessions_with_checkout"),
    ("rate_payment_to_purchase", "sessions_with_purchase", "sessions_with_payment"),
    ("overall_conversion_rate", "sessions_with_purchase", "total_sessions"),
)


def had(stage: str) -> str:
    """Name of the flag "the session contains this event"."""
    return f"had_{stage}"
