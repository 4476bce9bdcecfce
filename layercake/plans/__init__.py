"""The models: DataFrame builders from raw tables to marts."""

from layercake.plans.run import Run

__all__ = ["Run"]
