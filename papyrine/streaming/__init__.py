"""Stages run on whatever has arrived since the last run."""
