"""Entity, dimension, fact, semantic and report builders."""
