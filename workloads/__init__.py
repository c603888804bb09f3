"""The package's operators and datasets, run over the TPC-H-like test tables."""
