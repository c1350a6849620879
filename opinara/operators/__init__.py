"""DataFrame operators: shaping, filters, identity, roll-ups, story, trends, quality, profile."""
