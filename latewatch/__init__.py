"""latewatch: delay analytics, leakage-safe features and model quality as Spark DataFrame operators."""
