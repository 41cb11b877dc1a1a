"""rowloom: table analytics operators built from Spark's own primitives.

Every operator is ``f(DataFrame, ...) -> DataFrame``, lazy, and usable with
``df.transform``.  The letters in docstrings (W9, J12, ...) are the operator
"""
