"""Readers: lines, whole files, messages, ratings, dimension files, images."""
