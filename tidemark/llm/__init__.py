"""Operators that prepare training text: filtering, deduplication, formatting,
extraction, scoring, decontamination, mixing and sharding.  Nothing outside this
package imports it."""
