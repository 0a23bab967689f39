"""martloom: retail planning analytics expressed as Spark DataFrame plans."""

from martloom.rules import DEFAULT_RULES, Rules

__all__ = ["DEFAULT_RULES", "Rules"]
