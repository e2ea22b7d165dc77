"""plans of the section-analytics engine."""
