"""Catalogues and events as streams."""
