"""DataFrame-to-DataFrame steps: enrichment, aggregation, windows, forecasts, evaluation."""
