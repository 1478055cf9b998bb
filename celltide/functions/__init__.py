"""Column functions: distances and the hexagonal grid."""
