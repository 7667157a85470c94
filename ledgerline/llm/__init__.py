"""Operators for large-scale training-data preparation (one module per operator).

Every operator is ``DataFrame -> DataFrame``; Spark partitions and shuffles the
work, and numpy inside Arrow-batched tasks does the byte-level part. Nothing
else in the library imports this subpackage.
"""
