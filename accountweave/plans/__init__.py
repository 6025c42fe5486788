"""Marts, the queries served from them, and the runs that build them."""
