"""Operators that prepare training text: quality, duplicates, leaks, personal data, archives, tokens and chat formats."""
