"""DataFrame operators for sparse count matrices, genomic intervals, neighbour graphs and per-feature models."""
