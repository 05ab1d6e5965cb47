"""Whole-job plans: analysis periods, the per-quota (general) plan, the
single-pass plan and the job runner with its outputs."""
