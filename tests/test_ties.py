"""Equal intervals of different transcripts: the SQL of strict islands gives them one number in any order of rows."""

import duckdb
import pytest

from genoloom.plans import adapter as ad
from genoloom.plans import catalog

NAMES = ["merge_intervals_strict", "exon_components", "merge_annotations", "merged_lines"]


@pytest.mark.parametrize("name", NAMES)
def test_equal_intervals_get_one_number(name):
    """The running sum must not stop between rows that compare equal: a second sort may put them in another order."""
    strict = [line for line in catalog.oracle_sql()[name].splitlines() if "PARTITION BY seqid, strand ORDER BY s, e" in line and "SUM(o)" in line]
    assert strict and all("RANGE UNBOUNDED PRECEDING" in line for line in strict)


def test_ties_do_not_follow_the_order_of_rows():
    con = duckdb.connect()
    con.execute("CREATE TABLE raw AS SELECT * FROM (VALUES ('c', '+', 1, 5), ('c', '+', 9, 12), ('c', '+', 9, 12), ('c', '+', 9, 12), ('c', '+', 20, 21)) t(seqid, strand, s, e)")
    # Flags in the worst order: the row that opens the island comes last among its equals.
    parts = ad.merged_sql("raw", "m", "seqid, strand", 0, "RANGE").split(",\nm_g")
    flags = "m_o AS (SELECT *, CASE WHEN s = 1 OR s = 20 OR ROW_NUMBER() OVER (PARTITION BY s ORDER BY e) = 3 THEN 1 ELSE 0 END AS o FROM raw)"
    got = con.execute(f"WITH {flags},\nm_g{parts[1]} SELECT s, e, n FROM m ORDER BY s").fetchall()
    assert got == [(1, 5, 1), (9, 12, 3), (20, 21, 1)]
