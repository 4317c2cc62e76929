"""Fleet telemetry and table-maintenance analytics as plain DataFrame functions."""
