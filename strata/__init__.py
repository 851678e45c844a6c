"""Layered (raw -> clean -> aggregate) data toolkit made of DataFrame functions."""
