"""Spark jobs for multiplexed tissue imaging: image tiles and masks to cell tables, quality control and clusters."""
