"""Imports every query module so that their analyses register."""

from faresight.plans import q_profile  # noqa: F401
from faresight.plans import q_eval  # noqa: F401
from faresight.plans import q_drift  # noqa: F401
from faresight.plans import q_models  # noqa: F401
from faresight.plans import q_misc  # noqa: F401
from faresight.plans import q_io  # noqa: F401
