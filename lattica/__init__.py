"""A PySpark-native knowledge-graph engine: typed sources, quads, shapes, rules, lineage."""
