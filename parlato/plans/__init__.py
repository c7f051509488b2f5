"""End-to-end jobs, each one composed of sources and operators."""
