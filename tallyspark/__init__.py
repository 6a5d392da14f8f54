"""General-ledger analytics as Spark DataFrame operators."""
