"""Writers: Parquet, keyed merges, JDBC, exports and the model log."""
