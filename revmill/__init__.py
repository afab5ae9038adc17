"""Revenue analytics on Spark: star-schema loading, period metrics, business
questions, column statistics and daily price series, as DataFrame operators."""
