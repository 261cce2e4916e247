"""DataFrame -> DataFrame operators. Each works on batch and streaming frames unless noted."""
