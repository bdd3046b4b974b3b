"""cytoflux: single-cell variant analytics as Spark DataFrame plans."""
