"""Store-sales and ledger analytics as Spark DataFrame operators."""
