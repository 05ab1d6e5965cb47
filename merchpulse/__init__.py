"""Merchant business-health scoring on Spark DataFrames.

Reads a tall table of monthly merchant metrics, computes ten quotas per
merchant over a six-month window (plus the same window a year earlier),
bands each quota into a score and combines the scores into a weighted
0-100 result.  Every step is a DataFrame operator; see README.md.
"""

from merchpulse.plans.job import ScoreRun, score_all, score_one

__all__ = ["ScoreRun", "score_all", "score_one"]
