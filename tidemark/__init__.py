"""Event and change-stream analytics on PySpark DataFrames.

Every operator is a ``DataFrame -> DataFrame`` function. The same function serves a table read with
``spark.read`` and a stream read with ``spark.readStream`` unless its docstring says otherwise.
"""
