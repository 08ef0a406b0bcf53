"""Table operators: functions from DataFrame to DataFrame with explicit parameters."""
