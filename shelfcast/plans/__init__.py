"""End-to-end compositions of the operators: one lazy plan each."""

from shelfcast.plans.cleaning import audited_clean, clean_stage_frames, clean_transactions, cleaning_audit
from shelfcast.plans.demand import prepare_demand

__all__ = ["audited_clean", "clean_stage_frames", "clean_transactions", "cleaning_audit", "prepare_demand"]
