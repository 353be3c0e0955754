"""tidemark: subscription-business analytics as PySpark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame; nothing runs until the
caller writes or collects the result, except where a docstring says so.
"""
