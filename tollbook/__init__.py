"""Usage-record analytics on Spark: cleaning, star schema, manifest and read queries."""
