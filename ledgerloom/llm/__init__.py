"""Training-data operators: each one a Spark job with its own general interface."""
