"""DataFrame operators: windows, regularisation, statistics, joins, design matrices, terrain, models."""
