"""sources of the section-analytics engine."""
