"""Transaction risk and order analytics on Spark."""
