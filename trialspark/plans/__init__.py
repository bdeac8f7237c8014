"""Registered queries: each runs an operator over the driver tables, most with equivalent SQL."""

from trialspark.plans.registry import PLANS, Plan, load_all

__all__ = ["PLANS", "Plan", "load_all"]
