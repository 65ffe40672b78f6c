"""Column names and types of every layer, as schema strings."""

# Columns and types of the raw layer.
RAW = (
    "InvoiceNo string, StockCode string, Description string, Quantity double, "
    "InvoiceDate string, UnitPrice double, CustomerID string, Country string"
)
CLEANED = RAW + ", TotalPrice double"

# The numeric columns of the featured layer.
NUMERIC_FEATURES = (
    "Quantity", "UnitPrice", "TotalPrice", "Hour", "Day", "MonthNum", "WeekdayNum",
    "CountryEncoded", "ProductFrequency", "AvgCustomerSpend", "CustomerFrequency",
    "CustomerTotalQty", "CustomerPriceStd",
)
# Columns and types of the other layers.
FEATURED = (
    "InvoiceNo string, StockCode string, Description string, Quantity double, "
    "InvoiceDate timestamp, UnitPrice double, CustomerID string, Country string, "
    "TotalPrice double, Hour double, Day double, MonthNum double, WeekdayNum double, "
    "Month string, RevenueCategory string, CountryEncoded double, "
    "ProductFrequency double, AvgCustomerSpend double, CustomerFrequency double, "
    "CustomerTotalQty double, CustomerPriceStd double"
)
ANOMALY = FEATURED + ", anomaly int, anomaly_score double, anomaly_reason string"
CUSTOMER_SEGMENTS = (
    "CustomerID string, LastPurchaseDate timestamp, Frequency bigint, Monetary double, "
    "AvgTransaction double, TotalQuantity double, Recency int, Segment string"
)
CUSTOMER_BEHAVIOR = (
    "CustomerID string, TotalTransactions bigint, TotalSpent double, "
    "AverageTransactionValue double, AverageQuantity double, "
    "LastTransactionDate timestamp, CustomerType string"
)
JOINED = (
    "row_id bigint, Quantity double, UnitPrice double, TotalPrice double, anomaly int"
)
LAYERS = {
    "cleaned": CLEANED,
    "featured": FEATURED,
    "anomaly": ANOMALY,
    "customer_segments": CUSTOMER_SEGMENTS,
    "customer_behavior": CUSTOMER_BEHAVIOR,
    "joined": JOINED,
}

# Defaults of feature columns that come out empty.
FEATURE_DEFAULTS = {
    "CountryEncoded": 0.0,
    "ProductFrequency": 0.0,
    "AvgCustomerSpend": 0.0,
    "CustomerFrequency": 0.0,
    "CustomerTotalQty": 0.0,
    "CustomerPriceStd": 0.0,
}

# Column name and type of each field of the relational table.
WAREHOUSE_COLUMNS = (
    ("InvoiceNo", "invoice_no", "string"),
    ("StockCode", "stock_code", "string"),
    ("Description", "description", "string"),
    ("Quantity", "quantity", "double"),
    ("InvoiceDate", "invoice_date", "timestamp"),
    ("UnitPrice", "unit_price", "double"),
    ("CustomerID", "customer_id", "string"),
    ("Country", "country", "string"),
    ("TotalPrice", "total_price", "double"),
    ("Hour", "hour", "double"),
    ("Day", "day", "double"),
    ("MonthNum", "month_num", "double"),
    ("WeekdayNum", "weekday_num", "double"),
    ("Month", "month", "string"),
    ("RevenueCategory", "revenue_category", "string"),
    ("CountryEncoded", "country_encoded", "double"),
    ("ProductFrequency", "product_frequency", "double"),
    ("AvgCustomerSpend", "avg_customer_spend", "double"),
    ("CustomerFrequency", "customer_frequency", "double"),
    ("CustomerTotalQty", "customer_total_qty", "double"),
    ("CustomerPriceStd", "customer_price_std", "double"),
    ("anomaly", "anomaly", "int"),
    ("anomaly_score", "anomaly_score", "double"),
    ("anomaly_reason", "anomaly_reason", "string"),
)

# The two column lists of the sample exports.
SAMPLE_COLUMNS = (
    "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
    "CustomerID", "Country", "TotalPrice", "Hour", "Day", "MonthNum", "RevenueCategory",
    "CountryEncoded", "ProductFrequency", "AvgCustomerSpend", "CustomerFrequency",
    "CustomerTotalQty",
)
REPORT_COLUMNS = (
    "InvoiceNo", "CustomerID", "StockCode", "Description", "Quantity", "UnitPrice",
    "TotalPrice", "Country", "InvoiceDate", "Hour", "Day", "MonthNum", "RevenueCategory",
    "CountryEncoded", "ProductFrequency", "AvgCustomerSpend", "CustomerFrequency",
    "CustomerTotalQty", "CustomerPriceStd",
)
# The columns of the top transactions.
TOP_TRANSACTION_COLUMNS = (
    "InvoiceNo", "CustomerID", "Description", "Quantity", "UnitPrice", "TotalPrice",
    "Country",
)
