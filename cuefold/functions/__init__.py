"""Part of cuefold."""
