"""The validation plan: which metrics each target table gets."""
