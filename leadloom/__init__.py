"""Lead cleaning, classification and prioritisation as Spark DataFrame transforms."""
