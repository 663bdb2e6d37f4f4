"""pulsevault — a Spark-native wearable-health lakehouse (staging, Data Vault, business vault,
marts, breach alerts, data-quality checks and ML consumption) built on DataFrames."""

__version__ = "0.1.0"
