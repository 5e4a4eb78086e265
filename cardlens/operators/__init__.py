"""DataFrame -> DataFrame operators: merge, clean, features, skew-safe
joins, profiles, marts, data quality, ranking and modelling."""
