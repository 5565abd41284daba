"""Invariants of the reference's committed profiles, checked on the flagship build (sf0.001)."""

from pyspark.sql import functions as F

from featurepipe.config import DEFAULT
from featurepipe.operators import profile
from featurepipe.plans.bindings import ENTITY_ORDER, entity_bronze_raw, entity_relations
from featurepipe.plans.build import build_frames, split_frames

from tables import SF_SMALL


def test_flagship_invariants(spark):
    st = build_frames(entity_bronze_raw(spark, SF_SMALL), entity_relations(spark, SF_SMALL), list(ENTITY_ORDER),
                      DEFAULT, split_col="split")
    silver, hooked, gold = st.silver.cache(), st.hooked.cache(), st.gold.cache()
    by = lambda d: {r.split: r["count"] for r in d.groupBy("split").count().collect()}
    assert by(silver) == by(hooked) == by(gold)
    # dense row ids per split, unique keys
    for s, n in by(gold).items():
        ids = sorted(r._row_id for r in gold.where(F.col("split") == s).select("_row_id").collect())
        assert ids == list(range(n))
    assert gold.select("split", "tconst").distinct().count() == gold.count()
    # accent stripping only merges titles
    b = st.bronze.select("split", "tconst", "primaryTitle").dropDuplicates(["split", "tconst"])
    assert silver.select("primaryTitle").distinct().count() <= st.bronze.select("primaryTitle").distinct().count()
    # is_long_film is NULL exactly where the silver runtime was NULL
    nulls = silver.where(F.col("runtimeMinutes").isNull()).count()
    assert hooked.where(F.col("is_long_film").isNull()).count() == nulls
    # imputation leaves no NULL vote/runtime; gold flags have no NULL
    assert hooked.where(F.col("numVotes").isNull() | F.col("runtimeMinutes").isNull()).count() == 0
    for f in DEFAULT.flags + ("n_directors", "n_writers", "log_numVotes", "len_primaryTitle"):
        assert gold.where(F.col(f).isNull()).count() == 0, f
    # log is injective
    assert gold.select("log_numVotes").distinct().count() == gold.select("numVotes").distinct().count()
    # the report of all gates passed, labels only in train
    assert all((r.violations or 0) == 0 for r in st.gate_report.collect())
    parts = split_frames(gold)
    assert parts["val"].where(F.col("label").isNotNull()).count() == 0
    prof = profile(parts["train"], "gold_train").collect()
    assert {r.column for r in prof} >= set(DEFAULT.features)
