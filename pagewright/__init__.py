"""pagewright: document analytics on Spark."""
