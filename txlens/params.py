"""Business thresholds. Every operator that needs one takes it from here."""

from dataclasses import dataclass


# The reference thresholds of the retail rules.
@dataclass(frozen=True)
class Thresholds:
    revenue_high: float = 1000
    revenue_medium: float = 300

    segment_vip_monetary: float = 5000
    segment_vip_frequency: int = 50
    segment_loyal_monetary: float = 2000
    segment_frequent: int = 20
    segment_inactive_days: int = 90

    type_vip: float = 5000
    type_regular: float = 1000

    reason_unit_price: float = 100
    reason_total_price: float = 1000
    reason_quantity: float = 100

    contamination: float = 0.02
    alert_rate: float = 10
    alert_high: float = 10
    alert_watch: float = 5

    target_revenue: float = 550000
    target_anomalies: int = 300
    target_order_value: float = 50
    target_loss: float = 2000


DEFAULTS = Thresholds()

# The isolation forest settings.
FOREST_FEATURES = ("Quantity", "UnitPrice", "TotalPrice")
FOREST_TREES = 100
FOREST_SAMPLE = 256
FOREST_SEED = 42

# A lookup table is broadcast only when its measured size stays within both bounds.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 * 1024 * 1024
