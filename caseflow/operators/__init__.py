"""Operators, one module per stage of the patient timeline."""
