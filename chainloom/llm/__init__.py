"""Training-data operators: each is a Spark job that the rest of the library never imports."""
