"""Declared load plans: step chains and the config-driven end-to-end load."""
