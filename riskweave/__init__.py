"""riskweave: card-fraud analytics as composable Spark DataFrame functions."""
