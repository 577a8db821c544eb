"""Folders of the given tables (a plain module: two conftest files share one
module name, so nothing is imported from them)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
