"""Named queries over the driver tables, each with its oracle text where SQL can say it."""

from . import (cleaning_plans, describe_plans, feature_plans, metric_plans, model_plans, penalised_plans,  # noqa: F401
               sink_plans, structure_plans)
from .base import ORACLES, QUERIES  # noqa: F401
