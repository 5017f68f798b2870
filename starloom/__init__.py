"""starloom: dimensional warehouses and data-quality checks as plain PySpark.

Everything here is a ``Column -> Column`` or ``DataFrame -> DataFrame`` function.
The package never creates a session; callers pass one in or it is taken from the
DataFrame at hand.
"""
