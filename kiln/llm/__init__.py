"""Training-data operators: each module holds one operator with its own
DataFrame interface; ``catalog`` registers the queries on the test tables."""
