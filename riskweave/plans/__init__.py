"""Whole jobs and the working views they are tried on."""
