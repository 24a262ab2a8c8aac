"""Saltmarsh: a DataFrame-native engine for scholarly text and chemistry corpora."""
