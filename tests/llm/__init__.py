"""Tests of the corpus operators (a package, so that its conftest stands beside the other one)."""
