"""Operators for building training corpora (see README, "Training-data operators")."""
