"""Relational and ML operators of the workflow, each a lazy Spark plan."""
