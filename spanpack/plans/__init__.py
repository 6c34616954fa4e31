"""Job-level plans (several era tables in one job) and plan inspection."""

from spanpack.plans.jobs import ERA_OUTPUTS, build_era_tables, publish_era_tables

__all__ = ["ERA_OUTPUTS", "build_era_tables", "publish_era_tables"]
