"""tableguard: data-quality checks, staged table loads and upstream readiness
as Spark DataFrame plans."""

from .context import RunContext
from .spec import CheckConfigError, CheckSpec, TableRef, Threshold, rules_from_config
from .plans.suite import Suite, expected_rules, run_suite
from .plans.observe import ObservedChecks
from .operators import checks, freshness, history, loads, results

__all__ = [
    "CheckConfigError", "CheckSpec", "ObservedChecks", "RunContext", "Suite", "TableRef", "Threshold",
    "checks", "expected_rules", "freshness", "history", "loads", "results",
    "rules_from_config", "run_suite",
]
