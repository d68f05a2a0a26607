"""Where data comes from: topics and layer tables."""
