"""Readers, feed decoders and sinks."""
