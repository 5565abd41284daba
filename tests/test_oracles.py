"""Each registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from featurepipe.plans.bindings import TABLES

from tables import SF_SMALL

FAST = ["booster_splits", "profile_sink", "stage_order", "train_files", "hooks_chain", "strip_accents_turns", "csv_union_files", "csv_tolerant_files", "relation_files", "median_null_group",
        "profile_empty", "compare_stages", "gate_failure", "hook_audit", "stage_round_trip", "cv_scores", "importances",
        "fit_predict", "null_sentinels", "strip_accents", "changed_rows_topk", "repair_swap", "cast_range", "map_label",
        "dedup_first", "row_id", "row_id_by_group", "head", "union_by_name", "clean_relation",
        "relation_from_columns", "relation_from_records", "count_members", "relation_summary", "join_counts",
        "derived_features", "threshold_flags", "text_flags", "impute_median", "median_by_group", "profile",
        "coverage", "label_summary", "gate_report", "standardize", "stratified_folds", "gold_features"]


def _canon(df):
    import math
    cols = sorted(df.columns)
    out = []
    for row in df[cols].itertuples(index=False, name=None):
        vals = []
        for v in row:
            if v is None or v is getattr(__import__("pandas"), "NA") or (isinstance(v, float) and math.isnan(v)):
                vals.append(None)
            elif isinstance(v, float):
                vals.append(int(v) if v.is_integer() else round(v, 6))
            elif hasattr(v, "item"):
                vals.append(v.item())
            else:
                vals.append(v)
        out.append(tuple(vals))
    return cols, sorted(out, key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


_DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    types = {c: _DUCK_TYPES.get(t, t) for c, t, *_ in duck.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    assert dict(sdf.dtypes) == types
    got = sdf.toPandas()
    exp = duck.execute(E.oracle_sql()[name]).df()
    assert _canon(got) == _canon(exp)


def test_registry_complete():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {k for k in q if k != "pipeline" and not k.startswith("op")}
    assert own == own & set(o)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "log_numVotes" in df.columns
