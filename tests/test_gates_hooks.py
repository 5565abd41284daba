import pytest
from pyspark.sql import functions as F

from featurepipe.config import DEFAULT
from featurepipe.operators import GateError, HookRegistry, default_hooks, enforce, first_failure, gate_report, run_all_gates


def _frame(spark, rows):
    return spark.createDataFrame(rows, "tconst string, primaryTitle string, startYear double, "
                                       "runtimeMinutes double, numVotes double, label int, split string")


def test_gates_fire_in_order(spark):
    ok = _frame(spark, [("t1", "A", 1990.0, 90.0, 10.0, 1, "train"), ("t2", "B", None, 80.0, 5.0, 0, "train")])
    run_all_gates(ok, "train", DEFAULT.required, "tconst", "label", "startYear", 1880, 2030)
    dup = _frame(spark, [("t1", "A", 1990.0, 90.0, 10.0, 1, "x"), ("t1", "B", 1700.0, 80.0, 5.0, 7, "x")])
    with pytest.raises(GateError, match="key_unique"):
        run_all_gates(dup, "train", DEFAULT.required, "tconst", "label", "startYear", 1880, 2030)
    rep = {r.gate: r.violations for r in gate_report(dup, "train", DEFAULT.required, "tconst", "label",
                                                     "startYear", 1880, 2030).collect()}
    assert rep == {"required_columns": 0, "key_not_null": 0, "key_unique": 1, "label_values": 1, "year_range": 1}
    with pytest.raises(GateError, match="required_columns"):
        run_all_gates(dup.drop("numVotes"), "train", DEFAULT.required, "tconst", "label", "startYear", 1880, 2030)
    nulls = _frame(spark, [(None, "A", 1990.0, 1.0, 1.0, None, "test"), (None, "B", 1990.0, 1.0, 1.0, None, "test")])
    rep = {r.gate: r.violations for r in gate_report(nulls, "", DEFAULT.required, "tconst", "label", "startYear",
                                                     1880, 2030, split_col="split").collect()}
    assert rep["key_not_null"] == 2 and rep["key_unique"] == 1 and rep["label_values"] == 2
    rep = {r.gate: r.violations for r in gate_report(nulls, "", DEFAULT.required, "tconst", "label", "startYear",
                                                     1880, 2030, split_col="split", unlabelled=["test"]).collect()}
    assert rep["label_values"] is None
    train = _frame(spark, [(f"t{i}", "A", 1990.0, 1.0, 1.0, None, "train") for i in range(3)])
    with pytest.raises(GateError, match="label_values.*None: 3"):      # labels that all failed to map
        run_all_gates(train, "", DEFAULT.required, "tconst", "label", "startYear", 1880, 2030, split_col="split", unlabelled=["val"])
    many = _frame(spark, [(f"t{i}", "A", 1990.0, 1.0, 1.0, 2 + i, "train") for i in range(30)])
    with pytest.raises(GateError, match="and 25 more"):
        enforce(gate_report(many, "train", DEFAULT.required, "tconst", "label", "startYear", 1880, 2030), many, "label", shown=5)
    assert first_failure(gate_report(dup, "train", DEFAULT.required, "tconst", "label", "startYear", 1880, 2030)).first().gate == "key_unique"


def test_hooks_order_and_audit(spark):
    df = spark.createDataFrame(
        [("t1", "Saw 3", "Saw 3", "1925", None, 90.0, None), ("t2", "Up", None, "2000", "2001", None, 2e6),
         ("t3", "A  B", "X", "1990", None, 700.0, 10.0)],
        "tconst string, primaryTitle string, originalTitle string, startYear string, endYear string, "
        "runtimeMinutes double, numVotes double")
    reg = default_hooks(DEFAULT)
    out = reg.apply(df, "train")
    rows = {r.tconst: r for r in out.collect()}
    assert "endYear" not in out.columns
    assert rows["t1"].numVotes == 1000005.0           # median of {2e6, 10}
    assert rows["t2"].runtimeMinutes == 395.0          # median of {90, 700}, imputed after the flag
    assert rows["t2"].is_long_film is None and rows["t3"].is_long_film == 1
    assert (rows["t1"].is_old_film, rows["t2"].is_old_film) == (1, 0)
    # votes are imputed before the flag: t1 gets the median 1000005 > 1M
    assert (rows["t1"].is_blockbuster, rows["t2"].is_blockbuster, rows["t3"].is_blockbuster) == (1, 1, 0)
    assert (rows["t1"].is_foreign_title, rows["t2"].is_foreign_title, rows["t3"].is_foreign_title) == (0, 0, 1)
    assert (rows["t1"].title_word_count, rows["t3"].title_word_count) == (2, 2)
    assert (rows["t1"].title_has_number, rows["t2"].title_has_number) == (1, 0)
    audit = {r.hook: r for r in reg.audit(spark).collect()}
    assert list(audit) == ["drop_end_year", "impute_votes_median", "flag_long_film", "impute_runtime_median",
                           "flag_old_film", "flag_blockbuster", "flag_foreign_title", "add_title_features"]
    assert audit["add_title_features"].cols_added == ["title_has_number", "title_word_count"]
    assert all(a.rows_dropped == 0 for a in audit.values())

    custom = HookRegistry()
    custom.register(lambda d: d.where(F.col("tconst") != "t2"), name="drop_t2")
    assert custom.apply(df).count() == 2
    assert [(r.hook, r.rows_dropped) for r in custom.audit(spark).collect()] == [("drop_t2", 1)]
