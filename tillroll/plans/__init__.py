from tillroll.plans.jobs import Source, build_targets, run_batch, stage_sources
from tillroll.plans.targets import child_dim, registration_dim, sql_target, transaction_fact

__all__ = [
    "Source",
    "build_targets",
    "child_dim",
    "registration_dim",
    "run_batch",
    "sql_target",
    "stage_sources",
    "transaction_fact",
]
