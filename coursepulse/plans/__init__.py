"""Compositions: pages to records, records to tables, audit to recollection."""
