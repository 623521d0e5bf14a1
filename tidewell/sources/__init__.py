"""Where events come from: folders of JSON lines, and generators over tables."""
