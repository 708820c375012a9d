"""Composed jobs (file to file) and the registered queries over the test tables."""
