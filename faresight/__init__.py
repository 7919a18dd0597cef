"""faresight: leak-safe feature engineering, evaluation, drift monitoring and
model comparison for tabular regression data, written as Spark DataFrame plans.

Every operator is a function from DataFrame to DataFrame (or a
``pyspark.ml`` Estimator/Model pair) with the column roles passed in.
"""

from faresight.roles import Roles, FLIGHT_ROLES
from faresight.session import get_session, ensure_checkpoint_dir, materialize

__all__ = ["Roles", "FLIGHT_ROLES", "get_session", "ensure_checkpoint_dir", "materialize"]
