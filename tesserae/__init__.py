"""tesserae: a PySpark engine that builds and curates an entity-linking knowledge base."""

__version__ = "0.1.0"
