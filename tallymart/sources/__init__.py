"""Tables, landing files, event encoding and the adapters over the bundled test tables."""
