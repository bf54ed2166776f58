"""Customer-and-orders lakehouse jobs written for Spark."""
