"""kerbside: batch and streaming analytics over incident records, on Spark."""
