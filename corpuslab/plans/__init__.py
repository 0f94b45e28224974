"""Studies made of several operators."""
