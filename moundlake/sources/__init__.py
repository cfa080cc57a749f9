"""Sources and sinks: landed game-feed / schedule / roster JSON, CSV and
leaderboard tables, Parquet sinks and model persistence."""
