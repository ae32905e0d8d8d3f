"""Package part: functions."""
