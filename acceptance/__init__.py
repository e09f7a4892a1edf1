"""Registered queries, their oracle SQL and the comparison between both."""
