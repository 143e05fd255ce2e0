"""The stateless part of the build on arriving files."""
