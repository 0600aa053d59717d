"""Relational operators of a load: dedupe, compare, merge, CDC, quality, audit."""
