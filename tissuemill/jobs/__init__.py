"""Whole workloads, and the registered queries."""
