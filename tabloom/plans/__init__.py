"""Composed work: preprocessing chains, feature sets, models, ensembles, searches, the whole flow."""
