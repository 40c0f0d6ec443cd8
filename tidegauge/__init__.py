"""Labour-flow analytics as Spark jobs: feeds, levels, facts, forecasts and checks."""
