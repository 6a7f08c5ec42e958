"""Loading energy-market files into keyed and versioned tables, as Spark DataFrame jobs."""
