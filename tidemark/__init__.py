"""Land streams of JSON change records as files, on Spark."""
