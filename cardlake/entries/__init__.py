"""Registered queries: one per operator or report, each over whole tables."""
