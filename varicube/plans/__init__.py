"""The registered queries of the analytics operators."""
