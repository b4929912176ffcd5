"""Operators for preparing training text at scale (README, "Training-data operators")."""
