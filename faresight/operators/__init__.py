"""DataFrame → DataFrame operators: features, encoders, splits, profiles,
lookups, evaluation, drift, tracking and model training."""
