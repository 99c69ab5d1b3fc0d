"""Column-expression helpers; nothing here starts a Spark job."""
