"""chatloom: conversation and text analytics as composable Spark DataFrame operators."""
