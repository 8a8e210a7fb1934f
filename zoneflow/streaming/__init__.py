"""The pricing stream, the latest-price view over its output, and progress figures."""
