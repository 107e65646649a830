"""Contact-propensity analytics as composable Spark DataFrame functions."""
