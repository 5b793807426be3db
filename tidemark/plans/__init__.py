"""Whole builds: layers, storage of state, and the build in dependency order."""
