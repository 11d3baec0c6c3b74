"""Offermill: checks, ranks and publishes price-offer catalogues on Spark."""
