"""The registered queries: the star-schema test tables seen as fuel-price observations."""
