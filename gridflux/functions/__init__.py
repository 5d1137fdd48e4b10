"""Column expressions: semantics, spectral indices, projections, power transforms, images."""
