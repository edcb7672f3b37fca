"""Whole jobs (training, A/B test, period report) and the queries over the test tables."""
