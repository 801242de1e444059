"""Stages composed from operators, and reports over their results."""
