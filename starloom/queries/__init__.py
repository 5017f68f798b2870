"""Every operator as a query on the given tables, with the same query in SQL.

Importing the package registers all of them.
"""

from . import courses, extraction, files, scalars, shapes, tests_on_tables, warehouse  # noqa: F401
from .registry import REGISTRY  # noqa: F401
