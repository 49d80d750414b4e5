"""Match apartment offers with nearby public-transport stations on Spark."""
