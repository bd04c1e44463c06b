"""Customer-value and churn models on Spark ML."""
