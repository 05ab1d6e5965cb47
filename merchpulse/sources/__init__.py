"""Sources: the metric table from JDBC, parquet or a catalog table
(S1-S5), text files (S6, S7) and the test-table adapter."""
