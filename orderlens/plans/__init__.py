"""Operators put together: checks with their settings, and the reports over one data set."""
