"""kinweave: customer identity resolution and customer-360 analytics as Spark DataFrame jobs."""

from kinweave.config import DEFAULT_RULES, Rule

__all__ = ["DEFAULT_RULES", "Rule"]
