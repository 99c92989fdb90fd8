"""Text analytics over article tables on Spark: corpus, sentiment, search, trends."""
