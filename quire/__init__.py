"""quire — corpus, n-gram, feature and vector analytics as Spark DataFrame operators.

Every public operator is a function ``DataFrame(s) -> DataFrame`` built from
native Spark expressions, joins, aggregates and windows.  Python only runs in
the two places where Spark has no native equivalent (``.docx`` unpacking and
user-supplied batch predictors) and in the blocked similarity kernel, always
inside Spark tasks over Arrow batches.
"""

__all__ = ["session", "functions", "operators", "sources", "plans"]
