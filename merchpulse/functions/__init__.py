"""Column-level functions: exact sums and rounding, text trimming, calendar
columns and date-text cleaning."""
