"""curato: pick one representative image per hotel and keep it up to date, on Spark."""

from curato.plans.selection import Selection, select_and_reconcile
from curato.policy import Policy, Weights

__all__ = ["Policy", "Weights", "Selection", "select_and_reconcile"]
