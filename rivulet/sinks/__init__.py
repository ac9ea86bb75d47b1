"""Sinks: text/bus/console writers, keyed tables and batch logs, text reports."""
