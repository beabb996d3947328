"""Whole jobs built from the operators: people, diagnoses, drugs, risk and profiles."""
