"""DataFrame-to-DataFrame steps: privacy, derivations, enrichment, loading, checks."""
