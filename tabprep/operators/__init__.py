"""Operators over DataFrames: projections, profiles, preparation, models, tuning."""
