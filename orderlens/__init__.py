"""Order-economics and data-trust operators as Spark DataFrame functions."""
