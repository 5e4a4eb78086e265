"""The row-level transform applied to an incoming file stream."""
