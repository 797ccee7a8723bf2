"""millrace: order-to-cash analytics as lazy PySpark DataFrame jobs."""
