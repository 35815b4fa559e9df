"""Binding of the test tables to this package's inputs, and the check SQL."""
