"""Document-to-payable analytics on Spark: DataFrame operators, each also exposed as a checked query."""
