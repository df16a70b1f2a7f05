"""Transaction schema, feature catalogue and default parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column names, order, types and model defaults are the data
# contract and have to stay exactly as they are.
# ---------------------------------------------------------------------------
SOURCE_INDEX = "Unnamed: 0"
ROW_ID = "row_id"
LABEL = "is_fraud"

SOURCE_SCHEMA = T.StructType(
    [
        T.StructField(SOURCE_INDEX, T.LongType()),
        T.StructField("trans_date_trans_time", T.StringType()),
        T.StructField("cc_num", T.StringType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("amt", T.DoubleType()),
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("street", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("long", T.DoubleType()),
        T.StructField("city_pop", T.LongType()),
        T.StructField("job", T.StringType()),
        T.StructField("dob", T.StringType()),
        T.StructField("trans_num", T.StringType()),
        T.StructField("unix_time", T.LongType()),
        T.StructField("merch_lat", T.DoubleType()),
        T.StructField("merch_long", T.DoubleType()),
        T.StructField(LABEL, T.ByteType()),
    ]
)

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"

FEATURE_GROUPS: dict[str, list[str]] = {
    "temporal": ["hour_of_day", "day_of_week", "is_weekend", "month", "day_of_month"],
    "customer_velocity": [
        "customer_txn_count",
        "customer_avg_amt",
        "customer_std_amt",
        "customer_fraud_rate",
    ],
    "merchant_risk": [
        "merchant_fraud_rate",
        "merchant_txn_count",
        "merchant_avg_amt",
        "merchant_std_amt",
    ],
    "category": ["category_fraud_rate", "category_txn_count", "category_avg_amt"],
    "distance": ["distance_km", "is_distant_txn"],
    "amount": ["amt_zscore", "amt_is_outlier", "amt_ratio_to_customer_avg"],
    "raw_numeric": ["amt", "lat", "long", "city_pop", "merch_lat", "merch_long", "unix_time"],
}

ID_LIKE_COLUMNS = ["Unnamed: 0", "index", "id", "row_id"]

LOGISTIC_DEFAULTS = {"C": 1.0, "max_iter": 1000, "class_weight": "balanced"}
TREE_DEFAULTS = {
    "n_estimators": 400,
    "learning_rate": 0.05,
    "num_leaves": 63,
    "subsample": 0.9,
    "colsample_bytree": 0.9,
    "reg_lambda": 1.0,
    "reg_alpha": 0.0,
    "min_child_samples": 50,
    "random_state": 42,
}
SPLIT_DEFAULTS = {"test_size": 0.2, "val_size": 0.1, "seed": 42}
# --------------------------- end of fixed values ---------------------------

#: Columns of a loaded transaction table, in contract order.
TRANSACTION_COLUMNS = [ROW_ID if n == SOURCE_INDEX else n for n in SOURCE_SCHEMA.fieldNames()]

#: Request rows carry everything except the index, the time string and the label.
REQUEST_SCHEMA = T.StructType(
    [
        f
        for f in SOURCE_SCHEMA.fields
        if f.name not in (SOURCE_INDEX, "trans_date_trans_time", LABEL)
    ]
)

#: The 21 derived columns, in the order in which they are appended.
ENGINEERED = [
    name for group, names in FEATURE_GROUPS.items() if group != "raw_numeric" for name in names
]

#: Group statistics that scoring replaces by training-set medians.
GROUP_STATS = [
    name
    for group in ("customer_velocity", "merchant_risk", "category")
    for name in FEATURE_GROUPS[group]
]


def numeric_features(df: DataFrame, label: str = LABEL) -> list[str]:
    """Numeric predictors of ``df`` in column order, without label and id-like columns."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType)
        and f.name != label
        and f.name not in ID_LIKE_COLUMNS
    ]
