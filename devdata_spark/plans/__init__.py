"""Datasets: each module turns one publisher's landed files into tidy tables."""
