"""Part of traceloom."""
