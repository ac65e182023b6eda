"""Operators for preparing large text corpora (training data), each a Spark job.

Nothing outside this package imports it; ``__spark_entry__`` registers its queries only
when the package can be imported.
"""
