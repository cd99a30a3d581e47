"""Governed bronze / silver / gold sales warehouse on PySpark."""
