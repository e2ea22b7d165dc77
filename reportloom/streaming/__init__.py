"""streaming of the section-analytics engine."""
