"""Relational operators: formula inputs and updates, keyed scans, allocation, row keys."""
