"""equigap: Spark-native score-gap analytics.

Every public operator is a function from DataFrames (plus column names or a
``Roles`` binding) to a DataFrame or a Column.  Nothing here collects fact
rows to the driver; the only driver-side work is on aggregates whose size is
bounded by the number of groups, strata or model coefficients.
"""

from equigap.roles import Roles, resolve_roles  # noqa: F401
from equigap.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["Roles", "resolve_roles", "get_session", "checkpoint_dir"]
