"""Streaming forms: event time and watermarks, closed windows, result tables that survive replays, report streams."""
