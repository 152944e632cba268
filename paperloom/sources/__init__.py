"""Readers: acquisition of files, format probing, containers and native formats."""
