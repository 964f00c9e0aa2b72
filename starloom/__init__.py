"""starloom: dirty order text to a conformed star schema, and answers on it, in PySpark."""
