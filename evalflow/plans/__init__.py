"""Whole jobs: each is one lazy plan from source frames to result frames."""
