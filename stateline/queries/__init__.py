"""Queries over the test tables, each with the SQL it must agree with.

Importing the modules fills the registry. The queries call the library's own operators and plans
on whole tables; the SQL states the same result independently.
"""

from stateline.queries import cleaning, grouping, model, ordering, profiling, storage  # noqa: F401
from stateline.queries.registry import QUERIES, SQL  # noqa: F401
