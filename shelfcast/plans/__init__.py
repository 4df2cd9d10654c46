"""Whole jobs: lazy plans over input frames, and the command line that reads, runs and writes."""
