"""The batch stages as chains of operators."""

from txlens.functions.rules import anomaly_reason
from txlens.operators import cleaning, features, forest
from txlens.operators.anomalies import flag_anomalies
from txlens.operators.lookup import encode_by_frequency
from txlens.params import (DEFAULTS, FOREST_FEATURES, FOREST_SAMPLE, FOREST_SEED,
                           FOREST_TREES)
from txlens.staging import stage

ROW_KEY = ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
           "CustomerID", "Country")


LOOKUP_COLUMNS = ("Country", "StockCode", "CustomerID", "Quantity", "TotalPrice")
LOOKED_UP = ("CountryEncoded", "ProductFrequency", "AvgCustomerSpend", "CustomerFrequency", "CustomerTotalQty",
             "CustomerPriceStd")


def clean(raw, required=None):
    """Raw invoice lines to complete, sold and priced lines with their total.

    ``required``: the columns that make a line complete; all columns by default.
    """
    return (
        raw.transform(cleaning.strip_column_names)
        .transform(cleaning.drop_incomplete, required)
        .transform(cleaning.filter_positive_quantity)
        .transform(cleaning.filter_positive_price)
        .transform(cleaning.with_total_price)
    )


def build_features(cleaned, limits=DEFAULTS, staged=False):
    """Cleaned lines to the featured layer.

    The three lookup tables read a staged copy of the few columns they need, unless ``cleaned``
    is a plain scan already (``staged``); the rows themselves are read once and not shuffled
    unless a lookup table is large. Columns worked out from the row alone come after the lookups,
    so that such a shuffle does not carry them.
    """
    source = cleaned if staged else stage(cleaned.select(*LOOKUP_COLUMNS))
    rows = (
        cleaned.transform(encode_by_frequency, "Country", "CountryEncoded", source)
        .transform(features.with_product_frequency, source)
        .transform(features.with_customer_features, source)
        .transform(features.with_time_features)
        .transform(features.with_revenue_category, limits)
    )
    return (
        rows.select(*[name for name in rows.columns if name not in LOOKED_UP], *LOOKED_UP)
        .transform(features.fill_defaults)
        .transform(features.cast_numeric)
    )


def detect(featured, limits=DEFAULTS, key=ROW_KEY, trees=FOREST_TREES, sample=FOREST_SAMPLE,
           seed=FOREST_SEED):
    """Featured lines to scored, flagged and explained lines."""
    complete = cleaning.require_numbers(featured, FOREST_FEATURES)
    nodes = stage(forest.fit_isolation_forest(complete, FOREST_FEATURES, key, trees, sample, seed))
    # Staged, because the threshold takes several passes and scoring is the costly part.
    scored = stage(forest.score_isolation_forest(complete, nodes))
    flagged = flag_anomalies(scored, "score", limits.contamination)
    return flagged.withColumn("anomaly_reason", anomaly_reason(limits)).drop("score")
