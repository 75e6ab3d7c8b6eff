"""Job settings: window sizes, thresholds, labels and clock settings.

Every operator takes a ``Settings`` (default ``DEFAULTS``) so sizes and
thresholds are never hard-coded inside the operators themselves.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source application's constants for the
# outputs to match it (labels, thresholds, window sizes, date format, index
# names). Stated plainly, in the order the application uses them.
# ---------------------------------------------------------------------------
FOOT_JOIN_FIRST = "10 minutes"      # zone1 x zone2 window join
FOOT_JOIN_SECOND = "20 minutes"     # (zone1 x zone2) x zone3 window join
PROXIMITY_WINDOW = "30 minutes"     # proximity traffic per timestamp
JAM_WINDOW = "20 minutes"           # traffic jam over proximity output
CATEGORY_WINDOW = "15 minutes"      # category count
PAYMENT_WINDOW = "15 minutes"       # payment method count
STOCK_WINDOW = "15 minutes"         # stock availability
SALES_WINDOW = "30 minutes"         # total sales
CROWD_THRESHOLD = 25                # visitors >= 25 triggers the offer
STOCK_THRESHOLD = 30                # stock < 30 needs reordering
DATE_FORMAT = "MM/dd/yyyy HH:mm:ss"
NO_JAM_TEXT = "No sign of Traffic Jam at this moment"
REORDER_TEXT = "Item is below the System Quantity, needs REORDERING"
SUFFICIENT_TEXT = "Item Quantity is sufficient"
OFFER_MESSAGE = "Up to 70% Off on Kids Wear at H&M"
OFFER_SENDER = "Mall Discounts"
INDEX_FOOT_TRAFFIC = "flink-streams"
INDEX_PROXIMITY = "proximity-traffic"
INDEX_TRAFFIC_JAM = "traffic-jam"
INDEX_CATEGORIES = "product-categories"
INDEX_PAYMENT = "store-payment"
INDEX_STOCK = "stock-availability"
INDEX_SALES = "store-sales"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    """All tunables of the analytics jobs.

    ``watermark_delay`` only matters for streams: it bounds how late a row
    may arrive (by its ``arrival`` clock) and lets Spark close windows and
    drop their state.
    """

    foot_join_first: str = FOOT_JOIN_FIRST
    foot_join_second: str = FOOT_JOIN_SECOND
    proximity_window: str = PROXIMITY_WINDOW
    jam_window: str = JAM_WINDOW
    category_window: str = CATEGORY_WINDOW
    payment_window: str = PAYMENT_WINDOW
    stock_window: str = STOCK_WINDOW
    sales_window: str = SALES_WINDOW
    crowd_threshold: int = CROWD_THRESHOLD
    stock_threshold: int = STOCK_THRESHOLD
    date_format: str = DATE_FORMAT
    no_jam_text: str = NO_JAM_TEXT
    reorder_text: str = REORDER_TEXT
    sufficient_text: str = SUFFICIENT_TEXT
    offer_message: str = OFFER_MESSAGE
    offer_sender: str = OFFER_SENDER
    session_zone: str = "UTC"
    watermark_delay: str = "1 minute"
    # Second-tier (intended) variants; our own choices.
    visit_window: str = "2 hours"        # unique-MAC foot traffic
    sale_session_gap: str = "10 minutes"  # purchase sessions per seller
    scan_slice: str = "10 minutes"        # ordered scans cut a key into slices of this width
    bottom_k: int = 1                     # under-performing categories per window

    def with_(self, **changes) -> "Settings":
        return replace(self, **changes)


DEFAULTS = Settings()
