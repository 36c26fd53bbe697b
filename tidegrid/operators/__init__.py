"""DataFrame operators on measurement grids."""
