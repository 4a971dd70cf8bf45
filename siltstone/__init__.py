"""siltstone: routing, tracking and fidelity analytics for document corpora on PySpark."""
