"""functions of the section-analytics engine."""
