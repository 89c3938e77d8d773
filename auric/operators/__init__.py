"""DataFrame operators of the medallion layers."""
