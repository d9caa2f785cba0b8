"""turnout: running response counts over streams of nested JSON messages, on Spark."""
