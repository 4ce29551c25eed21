"""Operators: column rules, checks, profile, split, scaling, fits, scoring, evaluation, report."""
