"""Whole analysis jobs, composed of the operators."""

from clickloom.plans.funnel_job import FunnelAnalysis
from clickloom.plans.product_job import ProductAnalysis
from clickloom.plans.session_job import SessionAnalysis

__all__ = ["FunnelAnalysis", "ProductAnalysis", "SessionAnalysis"]
