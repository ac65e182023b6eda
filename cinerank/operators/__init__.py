"""Relational operators of the recommender, each a DataFrame -> DataFrame plan."""
