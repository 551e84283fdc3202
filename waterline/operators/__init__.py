"""DataFrame-to-DataFrame operators of the valuation model."""
