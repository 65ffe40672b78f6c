"""Labels that the retail rules put on rows, customers and summaries."""

from pyspark.sql import functions as F

from txlens.params import DEFAULTS


def revenue_category(limits=DEFAULTS):
    total = F.col("TotalPrice")
    return (
        F.when(total > limits.revenue_high, "High")
        .when(total > limits.revenue_medium, "Medium")
        .otherwise("Low")
    )


def anomaly_reason(limits=DEFAULTS):
    """Price outranks total, total outranks quantity."""
    return (
        F.when(F.col("UnitPrice") > limits.reason_unit_price, "Expensive Product")
        .when(F.col("TotalPrice") > limits.reason_total_price, "High Transaction")
        .when(F.col("Quantity") > limits.reason_quantity, "Large Quantity")
        .otherwise("Normal")
    )


def customer_segment(limits=DEFAULTS):
    monetary, frequency = F.col("Monetary"), F.col("Frequency")
    vip = (monetary > limits.segment_vip_monetary) & (frequency > limits.segment_vip_frequency)
    return (
        F.when(vip, "VIP Customer")
        .when(monetary > limits.segment_loyal_monetary, "Loyal Customer")
        .when(frequency > limits.segment_frequent, "Frequent Buyer")
        .when(F.col("Recency") > limits.segment_inactive_days, "Inactive Customer")
        .otherwise("Low Value Customer")
    )


def customer_type(limits=DEFAULTS):
    spent = F.col("TotalSpent")
    return (
        F.when(spent > limits.type_vip, "VIP")
        .when(spent > limits.type_regular, "Regular")
        .otherwise("Low Value")
    )


def status_label(column="anomaly"):
    return F.when(F.col(column) == 1, "Anomaly").when(F.col(column) == 0, "Normal")


def rate_alert(rate, limits=DEFAULTS):
    """Two levels: is the rate above the chosen limit?"""
    return F.when(rate > limits.alert_rate, "Alert").otherwise("Safe")


def rate_level(rate, limits=DEFAULTS):
    """Three levels of the anomaly page."""
    return (
        F.when(rate > limits.alert_high, "High")
        .when(rate > limits.alert_watch, "Watch")
        .otherwise("Normal")
    )


def direction_label(column):
    """Sign of a correlation; zero and NULL count as negative."""
    return F.when(F.col(column) > 0, "Positive").otherwise("Negative")
