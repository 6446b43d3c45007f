"""Domain packs and the layer runner that composes the operators."""
