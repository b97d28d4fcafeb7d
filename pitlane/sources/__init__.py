"""File sources: telemetry, participant and session files."""
