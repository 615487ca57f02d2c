"""Readers, contracts and sinks of the lake, and the sample feeds."""
