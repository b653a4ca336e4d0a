"""Risk features and risk scores from profiles and event logs, as Spark plans."""
