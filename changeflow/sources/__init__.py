"""Envelope sources, table catalog and message decoders."""
