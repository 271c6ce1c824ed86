"""Staging models, marts, consumer queries and refresh jobs."""
