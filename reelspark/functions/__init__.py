"""Part of reelspark."""
