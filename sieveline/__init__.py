"""sieveline: data-trust checks and market analytics as Spark DataFrame operators."""
