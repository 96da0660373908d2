"""Whole jobs made of the operators: crawl filtering, labelling, token preparation, evaluation."""
