"""Training-data operators on Spark; ``queries`` registers them."""
