"""reckon: a Spark-native reconciliation and data-repair engine for event feeds and ledgers."""
