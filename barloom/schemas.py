"""Layer schemas and column lists.

Every layer keeps ``series_key`` as its first column and ``date`` as the
time column.  The column lists below are fixed values of the pipeline
contract (layer layouts, feature selection, indicator spans).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

KEY = "series_key"
TS = "date"

# ---- fixed values of the pipeline contract -------------------------------
PRICE_COLS = ["open", "high", "low", "close"]
NUMERIC_COLS = ["open", "high", "low", "close", "volume"]
MA_WINDOWS = [7, 14, 30, 50]
VOLATILITY_WINDOWS = [7, 14, 30]
ROC_PERIODS = [7, 14]
VOLUME_SMA_WINDOWS = [7, 14]
RSI_WINDOW = 14
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
TRADING_DAYS = 252

GOLD_TECHNICAL_MARKERS = ["sma_", "ema_", "rsi", "volatility_", "atr_", "macd"]

GOLD_COLUMNS = [
    "open", "high", "low", "close", "volume", "volume_millions",
    "daily_return", "price_range", "avg_price",
    "sma_7", "sma_14", "sma_30", "sma_50",
    "ema_7", "ema_14", "ema_30", "ema_50",
    "price_sma_ratio_7", "price_sma_ratio_14", "price_sma_ratio_30", "price_sma_ratio_50",
    "rsi", "volatility_7", "volatility_14", "volatility_30",
    "atr_7", "atr_14", "atr_30",
    "roc_7", "roc_14", "momentum_7", "momentum_14",
    "macd", "macd_signal", "macd_histogram",
    "volume_sma_7", "volume_sma_14", "volume_ratio_7", "volume_ratio_14", "obv",
    "day_of_week", "month", "year",
    "target_close", "target_return", "target_direction",
]

PRIORITY_FEATURES = [
    "close", "volume", "daily_return", "price_range", "avg_price",
    "sma_7", "sma_14", "sma_30", "rsi", "volatility_7", "volatility_14",
    "macd", "volume_ratio_7", "obv", "day_of_week", "month",
]
TARGET_COLUMNS = ["target_close", "target_return", "target_direction"]
LAG_FEATURES = ["close", "volume", "daily_return", "rsi", "volatility_7"]
PIPELINE_MAX_LAG = 3
ROLLING_FEATURES = ["rolling_mean_7", "rolling_std_7", "rolling_mean_14", "volume_rolling_mean_7"]
TEST_SIZE, VAL_SIZE = 0.2, 0.1
# ---------------------------------------------------------------------------

BRONZE_SCHEMA = T.StructType([
    T.StructField(KEY, T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField(TS, T.TimestampNTZType()),
])

SILVER_EXTRA = ["daily_return", "price_range", "avg_price", "volume_millions",
                "day_of_week", "month", "year"]
INT_COLUMNS = {"day_of_week", "month", "year", "target_direction"}


def _layer(cols: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.IntegerType() if c in INT_COLUMNS else T.DoubleType()) for c in cols])


def silver_schema() -> T.StructType:
    return T.StructType([*BRONZE_SCHEMA.fields, *_layer(SILVER_EXTRA).fields])


def gold_schema() -> T.StructType:
    return T.StructType([T.StructField(KEY, T.StringType()), *_layer(GOLD_COLUMNS).fields,
                         T.StructField(TS, T.TimestampNTZType())])


def features_schema() -> T.StructType:
    lagged = [f"{c}_lag_{i}" for c in LAG_FEATURES for i in range(1, PIPELINE_MAX_LAG + 1)]
    types = _layer([*PRIORITY_FEATURES, *TARGET_COLUMNS, *lagged, *ROLLING_FEATURES])
    return T.StructType([T.StructField(KEY, T.StringType()), T.StructField(TS, T.TimestampNTZType()), *types.fields,
                         T.StructField("split", T.StringType())])

OHLCV_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("attributes", T.StructType([
            T.StructField("ohlcv_list", T.ArrayType(T.ArrayType(T.StringType()))),
        ])),
    ])),
])

SCALER_SCHEMA = T.StructType([
    T.StructField(KEY, T.StringType()),
    T.StructField("feature", T.StringType()),
    T.StructField("center", T.DoubleType()),
    T.StructField("scale", T.DoubleType()),
])

MODEL_RUNS_SCHEMA = T.StructType([
    T.StructField("run_name", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("run_ts", T.TimestampType()),
])


def feature_columns(cols: list[str]) -> list[str]:
    """Every column but the key, the date, the split and the targets."""
    drop = {KEY, TS, "split", "fold", *TARGET_COLUMNS}
    return [c for c in cols if c not in drop]


def target_columns(cols: list[str]) -> list[str]:
    """Names containing ``target``."""
    return [c for c in cols if "target" in c]


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of numeric columns, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
