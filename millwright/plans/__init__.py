"""Stages and report datasets as DataFrame plans."""
