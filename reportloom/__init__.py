"""Document-section analytics on Spark DataFrames: gates, boundaries, spans, audits and extraction over long reports."""
