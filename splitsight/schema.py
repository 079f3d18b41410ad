"""The canonical transaction table and the column lists shared by the operators."""

from pyspark.sql import types as T

TRANSACTION = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("transaction_date", T.TimestampNTZType()),
        T.StructField("transaction_amount", T.DoubleType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("subsidiary", T.StringType()),
    ]
)

# The same columns as they arrive before coercion.
RAW_TRANSACTION = T.StructType([T.StructField(f.name, T.StringType()) for f in TRANSACTION])

DEBIT = "DEBITO"

# Ties between rows with one id are settled by these columns, in this order.
KEEP_FIRST_ORDER = [
    "transaction_date",
    "transaction_amount",
    "merchant_id",
    "transaction_type",
    "subsidiary",
    "user_id",
]

# Model matrix, in matrix order (fixed values).
MODEL_FEATURES = [
    "cnt_24h",
    "sum_24h",
    "avg_amount",
    "amount_std",
    "unique_merchants",
    "unique_subsidiaries",
    "amount_cv",
    "amount_range",
    "merchant_concentration",
    "subsidiary_concentration",
    "same_amount_ratio",
    "avg_interval_minutes",
    "std_interval_minutes",
]

SLIDING_FEATURES = [
    "cnt_24h",
    "sum_24h",
    "avg_amount",
    "unique_merchants",
    "unique_subsidiaries",
    "hour_dispersion",
    "amount_cv",
    "amount_range",
    "merchant_concentration",
    "subsidiary_concentration",
    "same_amount_ratio",
    "avg_interval_minutes",
    "std_interval_minutes",
]

ANCHOR_FEATURES = [
    "cnt_24h",
    "sum_24h",
    "avg_amount",
    "unique_merchants",
    "unique_subsidiaries",
    "amount_cv",
    "merchant_concentration",
    "same_amount_ratio",
    "avg_interval_minutes",
]

# Metrics that get a historical mean and deviation (fixed values).
BASELINE_METRICS = [
    "cnt_24h",
    "sum_24h",
    "avg_amount",
    "unique_merchants",
    "merchant_concentration",
    "same_amount_ratio",
    "avg_interval_minutes",
]
