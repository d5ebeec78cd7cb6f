"""Customer-lifecycle analytics as Spark DataFrame plans."""
