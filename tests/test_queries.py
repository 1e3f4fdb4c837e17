import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
# quick ones here; tools/compare.py runs them all
QUICK = ["flagship_sample_counts", "j02_match_one_to_one", "s12_class_label", "f05_selection_ursaminor", "r02_priorities_ursaminor",
         "p15_flux_lists", "m05_membership_map", "m06_lookup_membership", "u06_wide_magnitudes", "w09_flux_by_band", "j17_reach",
         "g03_visit_table", "v04_group_limits", "u01_merge_lists"]


def plain(v):
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "orders", "customer", "part", "supplier", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = entry.queries()[name](spark, DATA)
    rel = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    cols = sorted(df.columns)
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    theirs = sorted((tuple(plain(row[i]) for i in order) for row in rel.fetchall()), key=repr)
    mine = sorted((tuple(plain(row[c]) for c in cols) for row in df.collect()), key=repr)
    assert mine == theirs and mine


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_registry_needs_no_session():
    import subprocess
    import sys
    from pathlib import Path
    code = "import __spark_entry__ as e; assert len(e.oracle_sql()) > 100 and len(e.queries()) > 100"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(entry.__file__).parent, timeout=120)
