"""operators of the section-analytics engine."""
