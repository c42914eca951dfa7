"""Spark-native analytics for news and document text.

Operators are plain functions ``DataFrame -> DataFrame`` (use them with
``df.transform``) or ``Column -> Column``.  Nothing here runs a job unless its
docstring says so.
"""
