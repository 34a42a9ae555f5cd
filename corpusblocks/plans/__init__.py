"""End-to-end compositions of sources and operators."""
