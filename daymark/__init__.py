"""Activity, history and session analytics as Spark DataFrame operators."""
