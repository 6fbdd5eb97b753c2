"""gridcheck: self-verifying tabular data and corpus preparation on Spark."""
