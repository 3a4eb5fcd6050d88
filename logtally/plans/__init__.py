"""Plans: the setup DAG and the registered query catalog."""

from logtally.plans.incremental import refresh
from logtally.plans.setup import SetupConfig, build_clean, build_raw, build_report, run_setup

__all__ = ["SetupConfig", "build_clean", "build_raw", "build_report", "refresh", "run_setup"]
