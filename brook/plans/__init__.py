"""Registered queries (DataFrame builders over the fixture tables) and their SQL oracles."""
