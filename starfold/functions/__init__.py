"""Column builders: photometry, sky geometry, arm geometry, null rules."""
