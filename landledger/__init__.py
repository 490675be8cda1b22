"""Sale-register, price-index and planning analytics as Spark DataFrame jobs."""
