"""The jobs: cleaning, sessions, customer scores, rollups, leakage, segments."""
