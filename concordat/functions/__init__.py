"""Part of the concordat package."""
