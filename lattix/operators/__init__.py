"""Operators on graphs: frames in, frames out."""
