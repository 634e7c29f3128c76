"""DataFrame-to-DataFrame operators over telemetry, scores and alerts."""
