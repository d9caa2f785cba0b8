"""Programs to run with spark-submit."""
